"""The data source of answers, offline: a folder of kept answers stands for the network."""

import json

import pytest
from pyspark.sql import functions as F

from provenir.sources import catalog, fetching
from provenir.sources.collect import spread

pytestmark = pytest.mark.usefixtures("small_plans")


def test_ten_thousand_documents_by_host(spark, tmp_path):
    urls = [f"https://host{k % 7}.example/doc/{k}" for k in range(10_000)]
    for k, url in enumerate(urls):
        fetching.keep_answer(tmp_path, url, f"body {k}".encode(), headers={"etag": str(k)})
    got = fetching.fetched(spark, [{"url": u} for u in urls], replay=str(tmp_path), requests_per_minute="100000")
    assert got.rdd.getNumPartitions() == 7
    right = (F.col("content").cast("string") == F.concat(F.lit("body "), F.col("seq"))) & (F.col("etag") == F.col("seq").cast("string")) & (F.col("status_code") == 200)
    told = got.select(F.count("*").alias("n"), F.count_if(right).alias("right"), F.countDistinct("seq").alias("ids")).first()
    assert tuple(told) == (10_000, 10_000, 10_000)


def test_errors_and_archive(spark, tmp_path):
    fetching.keep_answer(tmp_path / "r", "https://a.example/1", b"one")
    fetching.keep_answer(tmp_path / "r", "https://a.example/moved", b"", 302, {"location": "/1"})
    wanted = [{"url": f"https://a.example/{p}", "method": "POST", "body": b"q"} for p in ("1", "moved", "gone")]
    rows = fetching.fetched(spark, wanted, replay=str(tmp_path / "r"), on_error="row", archive=str(tmp_path / "raw"), source="s", run="r").orderBy("seq").collect()
    assert [(r["url"], r["content"] and bytes(r["content"])) for r in rows] == [("https://a.example/1", b"one"), ("https://a.example/1", b"one"), ("https://a.example/gone", None)]
    assert "404" in rows[2]["error"] and (tmp_path / "raw" / rows[0]["pointer"]).exists()
    with pytest.raises(Exception, match="404"):
        fetching.fetched(spark, wanted, replay=str(tmp_path / "r")).collect()
    assert fetching.fetched(spark, [], replay=str(tmp_path / "r")).count() == 0


def test_a_source_is_collected_by_the_executors(spark, tmp_path):
    boards = catalog.Source(id="greenhouse", name="g", owner="o", kind="k", connector="greenhouse", access_mode="api", attribution="by", base_url="https://x.example", redistribution="attributed", obey_robots=False, parameters={"boards": ["umi", {"token": "jobs", "company": "Jobs Co"}]})
    for token in ("umi", "jobs"):
        body = {"jobs": [{"id": k, "absolute_url": f"https://b/{token}/{k}", "title": f"Dev {k}", "content": "", "location": {"name": "Here"}} for k in range(2)]}
        fetching.keep_answer(tmp_path, f"https://boards-api.greenhouse.io/v1/boards/{token}/jobs?content=true", json.dumps(body).encode())
    batch = spread(spark, boards, run="r", replay=str(tmp_path))
    assert sorted((r["company_name"], r["title"]) for r in batch.jobs.collect()) == [("Jobs Co", "Dev 0"), ("Jobs Co", "Dev 1"), ("umi", "Dev 0"), ("umi", "Dev 1")]
    assert batch.documents.count() == 2 and batch.companies.count() == 2
    with pytest.raises(ValueError):
        spread(spark, catalog.Source(**(vars(boards) | {"connector": "himalayas"})), replay=str(tmp_path))


def test_cursors_are_offsets(spark, tmp_path):
    base, cursors = "https://h.example/jobs", ["", "n1", "n2"]
    for k, cursor in enumerate(cursors):
        body = {"jobs": [{"title": f"T{k}"}], "nextCursor": cursors[k + 1] if k < 2 else None}
        fetching.keep_answer(tmp_path / "r", base + "?limit=20" + (f"&cursor={cursor}" if cursor else ""), json.dumps(body).encode())
    spark.dataSource.register(fetching.FetchSource)

    def run(pages):
        stream = spark.readStream.format("provenir_fetch").options(url=base, replay=str(tmp_path / "r"), max_pages=pages).load()
        query = stream.select("seq", F.col("content").cast("string").alias("body")).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")).option("path", str(tmp_path / "out")).start()
        query.processAllAvailable()
        query.stop()
        return [json.loads(r["body"])["jobs"][0]["title"] for r in spark.read.parquet(str(tmp_path / "out")).orderBy("seq").collect()]

    assert run("2") == ["T0", "T1"] and run("100") == ["T0", "T1", "T2"]  # the second run goes on where the first stopped
