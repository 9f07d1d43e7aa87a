import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from provenir.llm import quality_rules as q

SCHEMA = "doc_id long, text string, lang string, source string, n_words string, `group` int, fit string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    times = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if times[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)


def stats(r):
    return r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]


def test_base_statistics(spark):
    texts = [None, "", " \t\n", "a", "a b", "a b c", "a b c a b c", "a a a a", "x y z q x y z x y z", "l\nl\n\n \nl", "é# $$ <b> | a\x0bb", "ab c d a bc d", "w " * 30_000, "日本 語 &"]
    rows = [(k, t, "en", "s") for k, t in enumerate(texts)] + [(None, "a b", None, None)]
    got = {r["doc_id"]: r for r in q.base_statistics(frame(spark, rows)).collect()}
    assert {k: stats(r) for k, r in got.items()} == {k: brute(t) for k, t, *_ in rows}
    assert all(got[k]["base_failed"] for k in range(14))


def test_small_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in q.apply_rules(docs).collect():
        assert stats(r) == brute(texts[r["doc_id"]])
        assert not (r["kept"] and r["base_failed"])


def test_labels(spark):
    sf = "/root/testdata/sf0.01"
    got = q.apply_rules(spark.read.parquet(f"{sf}/documents.parquet")).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("not base_failed").toPandas()
    assert got[got["quality"] == 1]["kept"].mean() > 0.97 and got[got["quality"] == 0]["kept"].mean() < 0.2


def test_minimum_covariance_resists_outliers(spark):
    pick = np.random.default_rng(4)
    mean, spread = np.array([1.5, 0.4, 0.3, 0.5]), np.array([0.3, 0.2, 0.25, 0.2])
    x = mean + pick.normal(size=(4000, 4)) * spread
    x[:800] = mean + np.array([4.0, 3.0, -3.0, 5.0]) + pick.normal(size=(800, 4)) * 0.1
    rows = spark.createDataFrame([("g", *map(float, r)) for r in x], "`group` string, " + ", ".join(f"{a} double" for a in q.AXES))
    fit = q.minimum_covariance(rows, share=0.75).first()["fit"]
    assert np.abs(np.array([fit[f"m{k}"] for k in range(4)]) - mean).max() < 0.03
    scale = np.array([1 / fit[f"c{k}{k}"] for k in range(4)])
    assert np.abs(scale / np.sqrt(spread**2 + np.array(list(q.AXES.values())) ** 2) - 1).max() < 0.2


def plain_estimate(x, share=0.75):
    """Mean and covariance of the smallest determinant, by the same starts and steps, with matrices."""
    floor = np.array(list(q.AXES.values()))
    at = lambda p: np.sort(x, axis=0)[max(0, math.ceil(p * len(x)) - 1)]
    med, spread = at(0.5), np.maximum((at(0.75) - at(0.25)) / 1.349, floor)
    z = (x - med) / spread
    length = np.linalg.norm(z, axis=1, keepdims=True)
    signs = np.divide(z, length, out=np.zeros_like(z), where=length > 0)
    cov = lambda y: np.cov(y.T, bias=True)
    both, least = np.outer(spread, spread), np.diag(floor**2)
    starts = [(med, np.diag(spread**2)), (x.mean(0), cov(x) + least), (med, cov(np.tanh(z)) * both + least), (med, 4 * signs.T @ signs / len(x) * both + least)]
    scale = share / q._chi2(q.chi2_quantile(share, 4), 6)

    def step(centre, scatter):
        d = x - centre
        bins = np.floor(np.log2(np.einsum("ij,ij->i", d @ np.linalg.inv(scatter), d) + 1e-6) * q.BINS_A_DOUBLING)
        kept = np.zeros(len(x), dtype=bool)
        for b in np.unique(bins):
            if kept.sum() >= share * len(x):
                break
            kept |= bins == b
        grown = 1 + (scale - 1) * min(1.0, (1 - kept.mean()) / (1 - share))
        return x[kept].mean(0), cov(x[kept]) * grown + least

    size = lambda fit: np.linalg.slogdet(fit[1])[1]
    best = min((step(*step(*s)) for s in starts), key=size)
    for _ in range(30):
        new = step(*best)
        if not size(new) < size(best) - 1e-6:
            break
        best = new
    return best


def test_estimate_is_that_of_the_plain_version(spark):
    pick = np.random.default_rng(11)
    groups = {}
    for g in range(5):
        a = pick.normal(size=(4, 4)) * 0.4
        x = pick.normal(size=(200 + 90 * g, 4)) @ a + pick.normal(size=4)
        x[: 40 * g // 2] += pick.normal(size=4) * 6
        groups[f"g{g}"] = x
    frame = spark.createDataFrame([(g, *map(float, r)) for g, x in groups.items() for r in x], "`group` string, " + ", ".join(f"{a} double" for a in q.AXES))
    found = {r["group"]: r["fit"] for r in q.minimum_covariance(frame).collect()}
    for g, x in groups.items():
        mean, cov = plain_estimate(x)
        inverse = np.linalg.inv(np.linalg.cholesky(cov))
        assert np.allclose([found[g][f"m{k}"] for k in range(4)], mean, atol=1e-8)
        assert np.allclose([found[g][f"c{i}{j}"] for i in range(4) for j in range(i + 1)], [inverse[i, j] for i in range(4) for j in range(i + 1)], rtol=1e-6, atol=1e-8)


def test_kept_is_that_of_the_plain_version(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("lang = 'en' and source < 'src13'")
    got = q.apply_rules(docs).join(docs.select("doc_id", "source"), "doc_id").toPandas()
    lines = {r["doc_id"]: sum(bool(WORD.search(x)) for x in (r["text"] or "").split("\n")) for r in docs.collect()}
    n = got["n_words"].clip(lower=1)
    got["x"] = list(np.stack([np.log(got["word_chars"].clip(lower=1) / n), np.sqrt(got["n_symbols"] / n), np.sqrt(got["n_dup_lines"] / got["doc_id"].map(lines).clip(lower=1)), np.sqrt(got["n_repeat_words"] / n)], axis=1))
    good = got[~got["base_failed"]]
    sizes = good["source"].value_counts()
    small = set(sizes[sizes < 40].index)
    pooled = sizes[list(small)].sum() if small else 0
    cut = q.chi2_quantile(1 - 1e-6, 4)
    for source, own in good.groupby(good["source"].map(lambda s: "small" if s in small else s)):
        if source == "small" and pooled < 40:
            assert own["kept"].all()
            continue
        x = np.stack(own["x"])
        mean, cov = plain_estimate(x)
        distance = np.einsum("ij,ij->i", (x - mean) @ np.linalg.inv(cov), x - mean)
        assert np.allclose(own["distance2"], distance, rtol=1e-5, atol=1e-8) and (own["kept"] == (distance <= cut)).all()
    assert not got[got["base_failed"]]["kept"].any()


def test_moderate_outliers_go(spark):
    pick = np.random.default_rng(2)
    vocabulary = [f"word{k}" for k in range(3000)]
    text = lambda: [str(w) for w in pick.choice(vocabulary, 300)]
    rows = [(k, " ".join(text()), "en", "s") for k in range(200)]
    symbols = text()
    symbols[::4] = [f"{w}#" for w in symbols[::4]]
    line = " ".join(text()[:12])
    lines = "\n".join([line] * 7 + [" ".join(text()[:12]) for _ in range(3)])
    part = text()[:60]
    repeats = " ".join(part + text()[:60] + part + text()[:60])
    rows += [(900, " ".join(symbols), "en", "s"), (901, lines, "en", "s"), (902, repeats, "en", "s"), (903, " ".join(w * 4 for w in text()), "en", "s")]
    got = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in q.apply_rules(frame(spark, rows)).collect()}
    assert all(got[k][1] for k in range(200)) and not any(got[k][1] for k in (900, 901, 902, 903)) and not got[900][0]


def test_many_groups_are_salted(spark, monkeypatch):
    monkeypatch.setattr(q, "FEW_GROUPS", 1)
    rows = spark.range(400).select(F.concat(F.lit("g"), F.col("id") % 3).alias("group"), *(F.rand(k).alias(a) for k, a in enumerate(q.AXES)))
    fits = spark.createDataFrame([("g0", 1), ("g1", 2)], "`group` string, fit int")
    assert q.with_fits(rows, fits).groupBy("group").agg(F.count("*").alias("n"), F.max("fit").alias("f")).orderBy("group").collect() == [("g0", 134, 1), ("g1", 133, 2)]
    assert q.with_fits(rows, fits, "left").filter("fit is null").count() == 133


def test_distance_is_mahalanobis(spark):
    pick = np.random.default_rng(5)
    a = pick.normal(size=(4, 4))
    cov, mean = a @ a.T + np.eye(4), pick.normal(size=4)
    columns = {(i, j): F.lit(float(cov[i, j])) for i in range(4) for j in range(i + 1)}
    row = spark.createDataFrame([(1.0, 2.0, 3.0, 4.0)], ", ".join(f"{a} double" for a in q.AXES)).withColumn("fit", q._whitening([F.lit(float(m)) for m in mean], columns, 4))
    x = np.array([1.0, 2.0, 3.0, 4.0]) - mean
    assert math.isclose(row.select(q.distance2("fit", 4).alias("d")).first()["d"], x @ np.linalg.solve(cov, x), rel_tol=1e-9)


def test_edges(spark):
    assert q.apply_rules(frame(spark, [])).count() == 0
    long = " ".join(f"w{k}" for k in range(60))
    rows = [(k, long, None, None if k % 2 else "s") for k in range(100)] + [(1, long, None, None)] * 2
    got = q.apply_rules(frame(spark, rows)).collect()
    assert len(got) == 102 and all(r["kept"] for r in got)
    assert math.isclose(q._chi2(q.chi2_quantile(0.9, 4), 4), 0.9, rel_tol=1e-9) and math.isclose(q.chi2_quantile(0.95, 4), 9.4877, rel_tol=1e-4)
