import numpy as np

from provenir.llm import quality_model as q
from provenir.llm.common import learnable
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = q.classify(docs, labels).join(labels.filter(~learnable(F.col("doc_id"))), "doc_id").toPandas()
    right = ((got["score"] >= 0.7) == (got["quality"] == 1)).mean()
    assert len(got) > 60 and right >= 0.85
    up, down = got[got["quality"] == 1]["score"], got[got["quality"] == 0]["score"]
    assert np.mean([(u > down).mean() for u in up]) > 0.93


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, 0.5), (2, "", 0.5), (3, "good words " * 30_000, 0.5), (3, "good words " * 30_000, 0.5), (None, "x", 0.5)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 1, "x"), (2, None, "x"), (3, 1, "x"), (4, 0, "x")], "doc_id long, quality int, text string")
    got = q.classify(docs, labels).collect()
    assert len(got) == 5 and {r["score"] for r in got} == {0.5}
    assert q.classify(docs.limit(0), labels.limit(0)).count() == 0
    model = q.train([q.features("good fine text"), q.features("bad $$$ junk"), q.features("fine good words"), q.features("junk $$$ again")], np.array([1, 0, 1, 0]))
    scored = {r["doc_id"]: r["score"] for r in q.score(docs, model).collect()}
    assert all(0 <= s <= 1 for s in scored.values()) and scored[1] == scored[2]
    assert model.score(q.features("good text")) > model.score(q.features("junk $$$"))


def test_ties_and_the_order_of_rows(spark):
    """Equal texts tie whatever their ids, and a model does not depend on the order or the partitions of its rows."""
    rows = [(k, ("clear calm prose number %d" if k % 2 else "$$ buy %d now $$") % (k % 5)) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)] + [(1, 1), (2, 0)], "doc_id long, quality int")
    one = {r["doc_id"]: r["score"] for r in q.classify(docs, labels).collect()}
    two = {r["doc_id"]: r["score"] for r in q.classify(docs.orderBy(F.desc("doc_id")).repartition(7), labels.orderBy(F.rand(3))).collect()}
    assert one == two and len(one) == 60
    by_text = {}
    for k, text in rows:
        by_text.setdefault(text, set()).add(one[k])
    assert len(by_text) == 10 and all(len(s) == 1 for s in by_text.values())


def test_dual_coordinate_descent_meets_its_conditions():
    pick = np.random.default_rng(2)
    rows = [np.unique(pick.integers(0, 60, 12)) + (0 if k % 2 else 20) for k in range(80)]
    labels = np.array([k % 2 for k in range(80)])
    model = q.dual_coordinate_descent(rows, labels, 1.0, epochs=400)
    ratio = q.log_count_ratios(rows, labels)
    y = np.where(labels == 1, 1.0, -1.0)
    x = np.zeros((80, q.SLOTS))
    for k, s in enumerate(rows):
        x[k, s] = ratio[s] / np.sqrt(len(s))
    x = x[:, : rows and max(s.max() for s in rows) + 1]
    w = np.divide(model.weights[: x.shape[1]], ratio[: x.shape[1]])
    objective = lambda w, b: 0.5 * (w @ w + b * b) + np.maximum(0, 1 - y * (x @ w + b)).sum()
    best = objective(w, model.bias)
    for _ in range(300):
        step = pick.normal(size=len(w)) * pick.choice((1e-3, 1e-2, 0.1))
        assert objective(w + step, model.bias + pick.normal() * 1e-3) >= best - 1e-6


def test_features_see_whole_texts():
    body = "word " * 20_000
    assert set(q.features(body)) < set(q.features(body + "tail"))
    assert len(q.features(None)) == 0
