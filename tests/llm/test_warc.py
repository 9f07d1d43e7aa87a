import base64
import hashlib
import os
import uuid
import zlib

import pytest

from provenir.llm import warc

SCHEMA = "page_id long, url string, html string, payload string, content int, original string, `key` int, bytes string, path int"


def sha(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def pages(spark, rows):
    return spark.createDataFrame([(*r, "p", 1, "o", 2, "b", 3) for r in rows], SCHEMA)


def test_round_trip(spark):
    rows = [(1, "http://a/", "same"), (5, None, "same"), (3, "http://c/\r\nX: y", "other é"), (4, "u", None), (9, "v", ""), (7, "w", "x" * 300_000), (5, None, "same"), (None, "n", "lone"), (8, "z", "a\r\n\r\nb")]
    got = warc.round_trip(pages(spark, rows), archive_bytes=200).collect()
    best = {}
    for i, _, h in rows:
        key = (h or "").encode()
        best[key] = max(best.get(key, -1), -1 if i is None else i)
    wanted = []
    for i, _, h in rows:
        key = (h or "").encode()
        again = (-1 if i is None else i) != best[key]
        wanted.append((i, len(key), sha(key), "revisit" if again else "response", best[key] if again else None))
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got), key=repr) == sorted(wanted, key=repr)
    texts = {r["page_id"]: bytes(r["payload"]) for r in got if r["record_type"] == "response"}
    assert texts[8] == b"a\r\n\r\nb" and texts[9] == b"" and len(texts[7]) == 300_000


def test_least_bytes(spark):
    got = warc.round_trip(pages(spark, [(1, "a", "xy"), (2, "b", "xy"), (3, "c", "long enough"), (4, "d", "long enough")]), least_bytes=5).collect()
    assert {r["page_id"]: r["record_type"] for r in got} == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_empty(spark):
    assert warc.round_trip(pages(spark, [])).count() == 0


@pytest.fixture
def archive():
    return b"".join(warc.page_record(k, f"http://x/{k}", b"payload %d" % k * 50, None, False, "2024-01-01T00:00:00Z") for k in range(5))


@pytest.mark.parametrize("step", [1, 7, 64, 10_000])
def test_any_chunks(archive, step):
    got = list(warc.read_records(archive[i : i + step] for i in range(0, len(archive), step)))
    assert [r.http[1] for r in got] == [b"payload %d" % k * 50 for k in range(5)]


def test_other_readers_agree(archive):
    import gzip

    plain = gzip.decompress(archive)
    assert plain.count(b"WARC/1.1\r\n") == 5 and plain.endswith(b"\r\n\r\n")


def test_damage(archive):
    with pytest.raises(warc.WarcError):
        list(warc.read_records([archive[:-5]]))
    with pytest.raises(warc.WarcError):
        list(warc.read_records([b"plain text"]))
    bad = warc.record({"WARC-Type": "response", "WARC-Payload-Digest": "sha1:" + sha(b"no")}, b"HTTP/1.1 200 OK\r\n\r\nyes")
    with pytest.raises(warc.WarcError):
        list(warc.read_records([bad]))


def member(text: bytes) -> bytes:
    packer = zlib.compressobj(9, zlib.DEFLATED, 31)
    return packer.compress(text) + packer.flush()


def foreign(kind, block, **more):
    lines = "".join(f"{k.replace('_', '-')}: {v}\r\n" for k, v in more.items())
    return f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:uuid:{uuid.UUID(int=len(block))}>\r\n{lines}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def test_records_of_others(spark, tmp_path):
    body = b"5\r\nhello\r\n1;x=y\r\n!\r\n0\r\n\r\n"
    chunked = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n" + body
    records = [
        foreign("warcinfo", b"software: other"), foreign("request", b"GET / HTTP/1.1\r\n\r\n"), foreign("response", b"HTTP/1.1 200 OK\r\n\r\nabc", WARC_Target_URI="http://a/", WARC_Block_Digest="sha256:" + hashlib.sha256(b"HTTP/1.1 200 OK\r\n\r\nabc").hexdigest()),
        foreign("response", chunked, WARC_Payload_Digest="sha1:" + sha(b"hello!")), foreign("revisit", b"HTTP/1.1 200 OK\r\n\r\n", WARC_Refers_To="<urn:uuid:0>"), foreign("metadata", b""), foreign("odd", b"x" * 200_000, WARC_Block_Digest="blake3:zz"),
    ]
    files = {"many.warc.gz": member(b"".join(records)), "one.warc.gz": b"".join(map(member, records)), "plain.warc": b"".join(records), "none.warc.gz": b""}
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    by_path = warc.read_archives(spark.createDataFrame([(f"file://{tmp_path}/{n}",) for n in files], "path string"))
    for found in (by_path, warc.read_archives(spark.read.format("binaryFile").load(str(tmp_path)).select("content"))):
        rows = found.collect()
        assert len(rows) == 21 and {r["page_id"] for r in rows} == {None}
        kinds = [r["record_type"] for r in rows]
        assert all(kinds.count(k) == n for k, n in {"warcinfo": 3, "request": 3, "response": 6, "revisit": 3, "metadata": 3, "odd": 3}.items())
        assert {(r["url"], bytes(r["payload"]), r["payload_digest"]) for r in rows if r["record_type"] == "response"} == {("http://a/", b"abc", sha(b"abc")), (None, body, sha(b"hello!"))}
        assert all(r["payload"] is None and r["refers_to_id"] == "<urn:uuid:0>" and r["payload_bytes"] is None for r in rows if r["record_type"] == "revisit")


@pytest.mark.parametrize("damage", [b"WARC/1.0\r\nContent-Length: 9\r\n\r\nabc\r\n\r\n", b"WARC/1.0\r\nContent-Length: x\r\n\r\n\r\n\r\n", b"WARC/1.0\r\nContent-Length: 2\r\n\r\nabc\r\n\r\n", foreign("response", b"abc", WARC_Block_Digest="sha1:" + sha(b"abd")), b"HTTP/1.1"])
def test_misframed(damage):
    for data in (member(damage), damage):
        with pytest.raises(warc.WarcError):
            list(warc.read_records([data]))


def test_a_block_beyond_the_limit_is_not_inflated():
    class Counted:
        taken = 0

    def chunks():
        data = member(foreign("response", b"\0" * 50_000_000))
        for i in range(0, len(data), 1000):
            Counted.taken += 1
            yield data[i : i + 1000]

    with pytest.raises(warc.WarcError):
        list(warc.read_records(chunks(), largest=1000))
    assert Counted.taken == 1


def test_files_stand_in_the_folder(spark, tmp_path):
    written = warc.write_archives(pages(spark, [(k, f"http://x/{k}", f"page {k} " * 500) for k in range(40)]), folder=str(tmp_path / "w"), archive_bytes=2000)
    listed = written.collect()
    files = sorted(str(f) for f in (tmp_path / "w").iterdir())
    assert files == sorted(r["path"] for r in listed) and len(files) > 3 and all(f.endswith(".warc.gz") for f in files)
    assert sum(r["records"] for r in listed) == 40 + len(files) and all(os.path.getsize(r["path"]) == r["bytes"] for r in listed)
    (tmp_path / "w" / "left.warc.gz.part").write_bytes(b"half")
    assert warc.read_archives(written).filter("record_type = 'response'").count() == 40


def test_one_body_on_most_pages(spark):
    rows = [(k, f"u{k}", "not found" if k % 3 else f"page {k}") for k in range(600)] + [(None, "n", "not found"), (None, "n", "not found"), (700, "a", "alone"), (700, "a", "alone")]
    got = warc.round_trip(pages(spark, rows)).collect()
    assert len(got) == 604 and sum(r["record_type"] == "response" for r in got) == 200 + 1 + 2
    assert {r["refers_to"] for r in got if r["record_type"] == "revisit"} == {599} and all(r["payload_bytes"] == 9 for r in got if r["record_type"] == "revisit")
