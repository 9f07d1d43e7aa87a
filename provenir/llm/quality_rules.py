"""Quality rules: base statistics of texts, and robust multivariate outliers per language and source."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from .common import fold, staged, unstage, words

#: Names of the transformed statistics, and the least spread of each: a difference of that much counts as no more than one
#: standard deviation, however alike the other texts are.
AXES = {"x_length": 0.08, "x_symbols": 0.08, "x_lines": 0.12, "x_repeats": 0.10}
BINS_A_DOUBLING = 16


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(tokens: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in the text.

    Windows are sorted by hash, so that equal ones are neighbours; the words that the repeated ones cover are
    counted from their sorted positions.
    """
    n = F.size(tokens)
    windows = F.transform(F.sequence(F.lit(1), n - 2), lambda i: F.struct(F.xxhash64(F.element_at(tokens, i), F.element_at(tokens, i + 1), F.element_at(tokens, i + 2)).alias("h"), i.alias("i")))
    at = lambda a, k: F.try_element_at(a, k)["h"]
    same = lambda a: F.filter(a, lambda w, k: F.coalesce((F.when(k > 0, at(a, k)) == w["h"]), F.lit(False)) | F.coalesce(at(a, k + 2) == w["h"], F.lit(False)))
    places = let(F.array_sort(windows), lambda a: F.array_sort(F.transform(same(a), lambda w: w["i"])))
    covered = let(places, lambda p: F.when(F.size(p) == 0, F.lit(0)).otherwise(3 + F.aggregate(F.sequence(F.lit(2), F.greatest(F.size(p), F.lit(2))), F.lit(0), lambda a, k: a + F.coalesce(F.least(F.lit(3), F.try_element_at(p, k) - F.try_element_at(p, k - 1)), F.lit(0)))))
    return F.when(n >= 3, covered).otherwise(F.lit(0)).cast("long")


def base_statistics(docs: DataFrame, least_words: int = 50, most_repeats: int = 50) -> DataFrame:
    """doc_id, lang, source, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words and base_failed; null texts are empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    split = docs.select("doc_id", "lang", "source", text.alias("text"), words(text).alias("tokens"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counted = split.select(
        "doc_id", "lang", "source",
        F.size("tokens").cast("long").alias("n_words"),
        F.length(F.array_join("tokens", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", r"[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"))).alias("lines"),
        repeated_words(F.col("tokens")).alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeats * F.col("n_words"))
    return counted.select("doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", F.col("lines.n").alias("n_lines"), F.col("lines.dup").alias("n_dup_lines"), "n_repeat_words", failed.alias("base_failed"))


def transformed() -> dict[str, Column]:
    """The statistics on scales where clean texts of one language and source scatter evenly."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "x_length": F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n),
        "x_symbols": F.sqrt(F.col("n_symbols") / n),
        "x_lines": F.sqrt(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))),
        "x_repeats": F.sqrt(F.col("n_repeat_words") / n),
    }


def _chi2(x: float, k: int) -> float:
    """Distribution function of chi-squared with an even number of degrees of freedom."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** j / math.factorial(j) for j in range(k // 2))


def chi2_quantile(p: float, k: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if _chi2(mid, k) < p else (low, mid)
    return low


def _whitening(mean: list[Column], cov: dict[tuple[int, int], Column], d: int) -> Column:
    """Means and the inverse Cholesky factor of a covariance, by rows, as one struct."""

    def factor(done: dict, i: int, j: int) -> Column:
        s = cov[i, j] - fold([done[i, k] * done[j, k] for k in range(j)], F.lit(0.0))
        return F.sqrt(F.greatest(s, F.lit(1e-12))) if i == j else s / done[j, j]

    names = [f"c{i}{j}" for i in range(d) for j in range(i + 1)]
    steps = [(i, j) for j in range(d) for i in range(j, d)]

    def build(rest: list, done: dict) -> Column:
        if rest:
            i, j = rest[0]
            return let(factor(done, i, j), lambda v: build(rest[1:], done | {(i, j): v}))
        inverse: dict[tuple[int, int], Column] = {}
        for i in range(d):
            inverse[i, i] = 1 / done[i, i]
            for j in range(i):
                inverse[i, j] = -fold([done[i, k] * inverse[k, j] for k in range(j, i)], F.lit(0.0)) / done[i, i]
        return F.struct(*(m.alias(f"m{k}") for k, m in enumerate(mean)), *(inverse[i, j].alias(n) for n, (i, j) in zip(names, ((i, j) for i in range(d) for j in range(i + 1)))))

    return build(steps, {})


def distance2(fit: str, d: int) -> Column:
    """Squared Mahalanobis distance of the transformed statistics under the struct `fit`."""
    x = [F.col(a) - F.col(f"{fit}.m{k}") for k, a in enumerate(AXES)]
    return fold([F.pow(fold([F.col(f"{fit}.c{i}{j}") * x[j] for j in range(i + 1)], F.lit(0.0)), 2) for i in range(d)], F.lit(0.0))


FEW_GROUPS = 20_000
SALTS = 64


def with_fits(rows: DataFrame, fits: DataFrame, kind: str = "inner") -> DataFrame:
    """`rows` (group, ...) with what `fits` (one row a group) has for their group.

    Up to FEW_GROUPS groups are counted and broadcast; beyond that the rows of a group are dealt over SALTS places.
    """
    if fits.count() <= FEW_GROUPS:
        return rows.join(F.broadcast(fits), "group", kind)
    salted = fits.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("_salt", F.pmod(F.xxhash64(*AXES), F.lit(SALTS)).cast("int")).join(salted, ["group", "_salt"], kind).drop("_salt")


def _moments(columns: list[Column], prefix: str) -> list[Column]:
    """Sums of the columns and of their products, two by two."""
    d = len(columns)
    return [F.sum(c).alias(f"{prefix}s{k}") for k, c in enumerate(columns)] + [F.sum(columns[i] * columns[j]).alias(f"{prefix}q{i}{j}") for i in range(d) for j in range(i + 1)]


def _starts(rows: DataFrame) -> DataFrame:
    """Four first estimates of each group, as rows (group, start, fit).

    0: medians, and spreads by quartiles; 1: mean and covariance of all rows; 2: covariance of rows squashed by tanh on
    the scale of 0; 3: covariance of their directions from the medians (spatial signs). 2 and 3 keep the medians.
    """
    names, floors, d = list(AXES), list(AXES.values()), len(AXES)
    pairs = [(i, j) for i in range(d) for j in range(i + 1)]
    quart = rows.groupBy("group").agg(*(F.percentile_approx(a, [0.25, 0.5, 0.75], 2000).alias(f"p{k}") for k, a in enumerate(names)))
    scaled = staged(quart.select("group", *(F.col(f"p{k}")[1].alias(f"med{k}") for k in range(d)), *(F.greatest((F.col(f"p{k}")[2] - F.col(f"p{k}")[0]) / 1.349, F.lit(f)).alias(f"spread{k}") for k, f in enumerate(floors))), "scales")
    z = [(F.col(a) - F.col(f"med{k}")) / F.col(f"spread{k}") for k, a in enumerate(names)]
    length = F.sqrt(fold([v * v for v in z], F.lit(0.0)))
    sums = with_fits(rows, scaled).groupBy("group").agg(
        F.count("*").alias("n"), *_moments([F.col(a) for a in names], "a"), *_moments([F.tanh(v) for v in z], "t"), *_moments([F.when(length > 0, v / length).otherwise(0.0) for v in z], "u")
    )
    n = F.col("n")
    med, spread = ([F.col(f"{c}{k}") for k in range(d)] for c in ("med", "spread"))
    least = lambda i, j: F.lit(floors[i] ** 2 if i == j else 0.0)
    cov = lambda p, i, j: F.col(f"{p}q{i}{j}") / n - F.col(f"{p}s{i}") / n * F.col(f"{p}s{j}") / n
    made = [
        _whitening(med, {(i, j): spread[i] * spread[i] if i == j else F.lit(0.0) for i, j in pairs}, d),
        _whitening([F.col(f"as{k}") / n for k in range(d)], {(i, j): cov("a", i, j) + least(i, j) for i, j in pairs}, d),
        _whitening(med, {(i, j): cov("t", i, j) * spread[i] * spread[j] + least(i, j) for i, j in pairs}, d),
        _whitening(med, {(i, j): d * F.col(f"uq{i}{j}") / n * spread[i] * spread[j] + least(i, j) for i, j in pairs}, d),
    ]
    return sums.join(scaled, "group").select("group", F.posexplode(F.array(*made)).alias("start", "fit"))


def log_determinant(fit: str, d: int) -> Column:
    """Of the covariance that a fit stands for."""
    return fold([-2 * F.log(F.col(f"{fit}.c{i}{i}")) for i in range(d)], F.lit(0.0))


def concentrated(rows: DataFrame, fits: DataFrame, share: float) -> DataFrame:
    """One concentration step: `fits` (group, start, fit) from the `share` of each group's rows that is nearest to them.

    Distances are counted in bins of a sixteenth of a doubling, with the sums that mean and covariance need; the bins up
    to the one in which the share is reached are kept. A step is one aggregate with partial sums, so a group of any size is
    spread over tasks. The covariance is scaled to that of normal rows, and each axis keeps its least spread.
    """
    names, floors, d = list(AXES), list(AXES.values()), len(AXES)
    pairs = [(i, j) for i in range(d) for j in range(i + 1)]
    scale = share / _chi2(chi2_quantile(share, d), d + 2)
    every = fits.groupBy("group").agg(F.collect_list(F.struct("start", "fit")).alias("_fits"))
    near = with_fits(rows, every).select("group", *names, F.explode("_fits").alias("_f")).select("group", *names, F.col("_f.start").alias("start"), F.col("_f.fit").alias("fit"))
    near = near.withColumn("bin", F.floor(F.log2(distance2("fit", d) + 1e-6) * BINS_A_DOUBLING).cast("int"))
    binned = near.groupBy("group", "start", "bin").agg(F.count("*").alias("n"), *_moments([F.col(a) for a in names], ""))
    whole = W.partitionBy("group", "start")
    nearest = whole.orderBy("bin").rowsBetween(W.unboundedPreceding, -1)
    kept = binned.withColumn("_before", F.coalesce(F.sum("n").over(nearest), F.lit(0))).withColumn("_all", F.sum("n").over(whole)).filter(F.col("_before") < share * F.col("_all"))
    total = kept.groupBy("group", "start").agg(F.sum("n").alias("n"), F.first("_all").alias("all"), *(F.sum(f"s{k}").alias(f"s{k}") for k in range(d)), *(F.sum(f"q{i}{j}").alias(f"q{i}{j}") for i, j in pairs))
    mean = [F.col(f"s{k}") / F.col("n") for k in range(d)]
    grown = 1 + (scale - 1) * F.least(F.lit(1.0), (1 - F.col("n") / F.col("all")) / (1 - share))
    cov = {(i, j): (F.col(f"q{i}{j}") / F.col("n") - mean[i] * mean[j]) * grown + F.lit(floors[i] ** 2 if i == j else 0.0) for i, j in pairs}
    return total.select("group", "start", _whitening(mean, cov, d).alias("fit"))


def minimum_covariance(rows: DataFrame, share: float = 0.75, first_steps: int = 2, most_steps: int = 30) -> DataFrame:
    """Minimum-determinant estimate of each group: rows (group, fit), from `rows` (group and the AXES).

    From each of four starts `first_steps` concentration steps are made; the result of the smallest determinant goes on
    until its determinant falls no more (or for `most_steps`). All groups are worked on at once. Equal determinants go by start.
    """
    d = len(AXES)
    fits = staged(_starts(rows), "mcd")
    for _ in range(first_steps):
        last, fits = fits, staged(concentrated(rows, fits, share), "mcd")
        unstage(last)
    size = log_determinant("fit", d)
    now = staged(fits.withColumn("size", size).groupBy("group").agg(F.min(F.struct("size", "start", "fit")).alias("b")).select("group", "b.start", "b.fit", "b.size", F.lit(True).alias("open")), "mcd")
    for _ in range(most_steps):
        going = now.filter("open").select("group", "start", "fit")
        if going.isEmpty():
            break
        step = concentrated(rows, going, share).select("group", F.col("fit").alias("_fit"), log_determinant("fit", d).alias("_size"))
        better = F.col("_size") < F.col("size") - 1e-6
        moved = now.join(step, "group", "left").select(
            "group", "start", F.when(better, F.col("_fit")).otherwise(F.col("fit")).alias("fit"), F.when(better, F.col("_size")).otherwise(F.col("size")).alias("size"), F.coalesce(better, F.lit(False)).alias("open")
        )
        last, now = now, staged(moved, "mcd")
        unstage(last)
    return now.select("group", "fit")


def apply_rules(docs: DataFrame, least_rows: int = 40, confidence: float = 1 - 1e-6, **base) -> DataFrame:
    """Base statistics of every document of `docs` (doc_id, text, lang, source), the outlier distance and `kept`.

    Texts that fail the base rules are dropped and take no part in the estimates. The others are measured within
    their language and source, or, where fewer than `least_rows` are left, with the other small sources of their
    language, or with all such rest; a rest that is still smaller has no estimate and is kept. Kept is a squared distance
    up to the `confidence` quantile of chi-squared: with the least spreads of AXES and no spread of the group's own, about
    0.21 symbols a word, 48 % repeated lines or 33 % repeated words on their own are the most that passes. Null texts count as
    empty (and fail); very long texts are measured whole; null languages and sources are groups of their own; ties in
    distance are kept or dropped together; repeated rows count each; other columns are ignored, whatever their names; an
    empty table gives no rows.
    """
    measured = staged(base_statistics(docs, **base).select("*", *(c.alias(a) for a, c in transformed().items())), "statistics")
    good = measured.filter(~F.col("base_failed"))
    own = F.to_json(F.struct(F.col("lang"), F.col("source")), {"ignoreNullFields": "false"})
    sizes = staged(good.groupBy("lang", "source").count(), "sizes")
    by_lang = sizes.filter(F.col("count") < least_rows).groupBy("lang").agg(F.sum("count").alias("_lang")).select(F.col("lang").alias("_l"), "_lang")
    rest = sizes.join(by_lang, sizes["lang"].eqNullSafe(by_lang["_l"]), "left")
    group = F.when(F.col("count") >= least_rows, own).when(F.col("_lang") >= least_rows, F.to_json(F.struct("lang"), {"ignoreNullFields": "false"})).otherwise(F.lit("rest"))
    # what a group is called follows from its language and source, so the rows look it up as they look up a fit
    named = rest.select(own.alias("group"), group.alias("named"))
    placed = staged(with_fits(measured.withColumn("group", own), named, "left").drop("group").withColumnRenamed("named", "group"), "grouped")
    unstage(measured)
    enough = placed.filter(~F.col("base_failed"))
    large = staged(enough.groupBy("group").count().filter(F.col("count") >= least_rows).select("group"), "large")
    fits = minimum_covariance(with_fits(enough.select("group", *AXES), large))
    judged = with_fits(placed, fits, "left").withColumn("distance2", distance2("fit", len(AXES)))
    kept = ~F.col("base_failed") & (F.coalesce(F.col("distance2"), F.lit(0.0)) <= chi2_quantile(confidence, len(AXES)))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "distance2")
