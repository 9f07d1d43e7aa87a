"""The store: transactions of several writers, buckets, indexes, keys."""

import threading

import pytest
from pyspark.sql import functions as F

from provenir.schemas import TABLES
from provenir.sinks.store import DuplicateKey, StaleWrite, Store, Upserted, _Taken

pytestmark = pytest.mark.usefixtures("small_plans")


def rows(spark, name, *values):
    """Rows of a table from dictionaries; other columns are null."""
    fields = [c.split(" ", 1)[0] for c in TABLES[name].split(", ")]
    return spark.createDataFrame([tuple(v.get(f) for f in fields) for v in values], TABLES[name])


def runs(spark, *ids, status="completed"):
    return rows(spark, "ingestion_runs", *({"run_id": i, "source_id": "s", "status": status} for i in ids))


def firms(spark, *pairs):
    return rows(spark, "companies", *({"company_id": i, "domain": d, "canonical_name": i.upper()} for i, d in pairs))


def ids(frame, column="run_id"):
    return sorted(r[column] for r in frame.collect())


def test_two_readers_of_one_version(spark, tmp_path):
    """The second to replace what both have read is told, and its retry keeps both changes."""
    root = f"file://{tmp_path}/t"
    one, two = Store(spark, root), Store(spark, root)
    one.commit({"ingestion_runs": runs(spark, "a")})
    seen, also = one.read("ingestion_runs"), two.read("ingestion_runs")
    one.commit({"ingestion_runs": seen.unionByName(runs(spark, "b"))})
    with pytest.raises(StaleWrite, match="ingestion_runs"):
        two.commit({"ingestion_runs": also.unionByName(runs(spark, "c"))})
    assert ids(one.read("ingestion_runs")) == ["a", "b"]
    again = two.snapshot()
    again.commit({"ingestion_runs": again.read("ingestion_runs").unionByName(runs(spark, "c"))})
    assert ids(two.read("ingestion_runs")) == ["a", "b", "c"]


def test_upserts_of_one_version_both_survive(spark, tmp_path):
    root = str(tmp_path / "t")
    Store(spark, root).commit({"ingestion_runs": runs(spark, "a")})
    one, two = Store(spark, root).snapshot(), Store(spark, root).snapshot()
    one.commit({"ingestion_runs": Upserted(runs(spark, "a", "b", status="failed"))}, reads=())
    two.commit({"ingestion_runs": Upserted(runs(spark, "c"))}, {"n": 1}, reads=())
    now = Store(spark, root).snapshot()
    assert sorted((r["run_id"], r["status"]) for r in now.read("ingestion_runs").collect()) == [("a", "failed"), ("b", "failed"), ("c", "completed")] and now.notes == {"n": 1}
    three = Store(spark, root).snapshot()
    now.commit({"companies": Upserted(firms(spark, ("x", None)))}, reads=("companies",))
    three.commit({"ingestion_runs": Upserted(runs(spark, "d"))}, reads=("ingestion_runs",))  # nothing that it read has changed
    with pytest.raises(StaleWrite, match="companies"):
        three.commit({"ingestion_runs": Upserted(runs(spark, "e"))}, reads=("companies",))
    assert ids(Store(spark, root).read("ingestion_runs")) == ["a", "b", "c", "d"]


def test_one_of_many_creates_a_version(spark, tmp_path):
    store, told = Store(spark, str(tmp_path / "t")), []
    store.commit({"ingestion_runs": runs(spark, "a")})
    gate = threading.Barrier(6)

    def publish(k):
        gate.wait()
        try:
            store._publish(2, {"version": 2, "tables": store.snapshot(1).pointer["tables"], "changed": [], "notes": {"by": k}})
            told.append(k)
        except _Taken:
            pass

    threads = [threading.Thread(target=publish, args=(k,)) for k in range(6)]
    [t.start() for t in threads], [t.join() for t in threads]
    assert len(told) == 1 and store.notes() == {"by": told[0]} and not list((tmp_path / "t").glob("draft-*"))


def test_writers_at_once_lose_nothing(spark, tmp_path):
    root = str(tmp_path / "t")
    Store(spark, root).commit({"ingestion_runs": runs(spark, "a")})
    threads = [threading.Thread(target=lambda k=k: Store(spark, root).commit({"ingestion_runs": Upserted(runs(spark, f"w{k}"))}, reads=())) for k in range(4)]
    [t.start() for t in threads], [t.join() for t in threads]
    store = Store(spark, root)
    assert ids(store.read("ingestion_runs")) == ["a", "w0", "w1", "w2", "w3"] and store.version() == 5


def test_a_failed_commit_leaves_the_last_version(spark, tmp_path, monkeypatch):
    store = Store(spark, f"file://{tmp_path}/t")
    assert store.version() == 0 and store.read("jobs").count() == 0 and store.snapshot().tables().keys() == TABLES.keys()
    store.commit({"ingestion_runs": runs(spark, "a")}, {"n": 1})
    with monkeypatch.context() as m:
        m.setattr(Store, "_publish", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            store.commit({"ingestion_runs": runs(spark, "b")})
    with pytest.raises(StaleWrite):
        store.commit({"ingestion_runs": runs(spark, "x")}, base=0)
    assert (store.version(), store.notes(), ids(store.read("ingestion_runs"))) == (1, {"n": 1}, ["a"])


def test_an_upsert_writes_touched_buckets_only(spark, tmp_path):
    store = Store(spark, str(tmp_path / "t"), bucket_rows=10)
    many = [(f"c{k:03}", f"d{k % 40}.test") for k in range(160)]
    store.commit({"companies": firms(spark, *many)})
    before = store.snapshot()
    was = before.manifest("companies")
    assert was["buckets"] == 16 and was["rows"] == 160 and len(was["parts"]) > 8
    store.commit({"companies": Upserted(firms(spark, ("c007", "new.test"), ("c200", "d7.test")))})
    now = store.snapshot()
    made = now.manifest("companies")
    changed = [b for b in made["parts"] if made["parts"][b] != was["parts"].get(b)]
    assert 1 <= len(changed) <= 2 and made["rows"] == 161 and sum(p["rows"] for p in made["parts"].values()) == 161
    assert len([b for b in made["indexes"]["domain"]["parts"] if made["indexes"]["domain"]["parts"][b] != was["indexes"]["domain"]["parts"].get(b)]) <= 2
    want = dict(many) | {"c007": "new.test", "c200": "d7.test"}
    assert {r["company_id"]: r["domain"] for r in now.read("companies").collect()} == want
    assert {r["company_id"]: r["domain"] for r in before.read("companies").collect()} == dict(many)  # the version that was read stays
    asked = spark.createDataFrame([("d7.test",), ("new.test",), (None,), ("none.test",)], "domain string")
    found = now.lookup("companies", "domain", asked)
    assert ids(found, "company_id") == sorted(i for i, d in want.items() if d in ("d7.test", "new.test")) and len(found.inputFiles()) < len(now.read("companies").inputFiles())
    assert ids(before.lookup("companies", "domain", asked), "company_id") == sorted(i for i, d in many if d == "d7.test")


def test_buckets_grow_with_the_table(spark, tmp_path):
    store = Store(spark, str(tmp_path / "t"), bucket_rows=10)
    store.commit({"companies": Upserted(firms(spark, *((f"a{k}", None) for k in range(5))))})
    store.commit({"companies": Upserted(firms(spark, *((f"b{k}", f"d{k}") for k in range(95))))})
    manifest = store.snapshot().manifest("companies")
    assert manifest["buckets"] == 16 and manifest["rows"] == 100 and store.read("companies").count() == 100
    assert store.snapshot().lookup("companies", "domain", spark.createDataFrame([("d9",)], "domain string")).first()["company_id"] == "b9"


def test_kinds_of_upsert(spark, tmp_path):
    store = Store(spark, str(tmp_path / "t"))
    store.commit({"companies": Upserted(firms(spark, ("a", "one"), ("b", "two")))})
    store.commit({"companies": Upserted(firms(spark, ("a", "x"), ("c", "three")), keep=True)})
    store.commit({"companies": Upserted(firms(spark, ("b", "y"), ("d", "four")).withColumn("canonical_name", F.lit("Z")), columns=("canonical_name",))})
    assert sorted((r["company_id"], r["domain"], r["canonical_name"]) for r in store.read("companies").collect()) == [("a", "one", "A"), ("b", "two", "Z"), ("c", "three", "C"), ("d", "four", "Z")]
    assert store.commit({"companies": Upserted(firms(spark).limit(0))}) == 4 and store.read("companies").count() == 4


@pytest.mark.parametrize("bad", [("a", "a"), ("a", None)])
def test_keys_are_unique_and_filled(spark, tmp_path, bad):
    store = Store(spark, str(tmp_path / "t"))
    for change in (lambda r: r, Upserted):
        with pytest.raises(DuplicateKey):
            store.commit({"ingestion_runs": change(runs(spark, *bad))})
    store.commit({"ingestion_runs": runs(spark, "z")})
    with pytest.raises(DuplicateKey):
        store.commit({"ingestion_runs": Upserted(runs(spark, *bad))})
    assert ids(store.read("ingestion_runs")) == ["z"]


def test_vacuum_keeps_what_is_referred_to(spark, tmp_path):
    store = Store(spark, str(tmp_path / "t"), bucket_rows=4)
    store.commit({"companies": firms(spark, *((f"c{k}", f"d{k}") for k in range(20)))})
    for k in range(3):
        store.commit({"companies": Upserted(firms(spark, (f"c{k}", "moved")))})
    assert store.vacuum(keep=1) > 0 and store.vacuum(keep=1) == 0
    assert store.version() == 4 and store.read("companies").filter("domain = 'moved'").count() == 3 and store.read("companies").count() == 20
    store.commit({"companies": Upserted(firms(spark, ("c9", "moved")))})
    assert store.snapshot().lookup("companies", "domain", spark.createDataFrame([("moved",)], "domain string")).count() == 4
