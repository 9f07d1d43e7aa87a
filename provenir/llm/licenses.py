"""License scan: a positional index of the rarest licence words of each file."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from .common import staged
from .license_texts import TEMPLATES

#: Base phrases with their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: What is no part of a word, and the letters that are made small.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: str) -> list[str]:
    """The words of a licence text, as `scan` cuts those of a file."""
    return [w for w in re.split(NOT_WORD, text.translate(str.maketrans(CAPITALS, SMALL))) if w]


def _strings(values) -> Column:
    """A constant array of words (which hold no blank)."""
    values = list(values)
    return F.split(F.lit(" ".join(values)), " ") if values else F.array().cast("array<string>")


def _small(text: Column) -> Column:
    """A-Z made small and nothing else; texts of ASCII alone take the shorter way."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, CAPITALS, SMALL))


def document_frequencies(tokens: DataFrame, vocabulary: list[str]) -> tuple[dict[str, int], int]:
    """Documents that hold each word of `vocabulary`, and all documents: counted over every text; a row a word reaches the driver."""
    held = tokens.select(F.explode(F.array_append(F.array_intersect("tokens", _strings(vocabulary)), F.lit("\n"))).alias("word")).groupBy("word").count()
    found = {r["word"]: r["count"] for r in held.collect()}
    return {w: found.get(w, 0) for w in vocabulary}, found.get("\n", 0)


def _base_places(tokens: Column, phrase: str) -> Column:
    first, *rest = phrase.split()
    held = F.filter(F.transform(tokens, lambda w, i: F.when(w == first, i)), lambda i: i.isNotNull())
    for k, word in enumerate(rest):
        held = F.filter(held, lambda i: F.try_element_at(tokens, i + k + 2).eqNullSafe(F.lit(word)))
    return held


def alignments(files: DataFrame, templates, idf: dict[str, float], most_rare: int, slack: int, share: float) -> DataFrame:
    """(key, template, start): where the texts of `templates` may begin in `files` (key, tokens, maybe: numbers of templates).

    Of the words that a file and a template have in common, the `most_rare` of highest IDF are looked up, at all their places
    in the file and all in the template. A pair of places says where the template would begin; beginnings within `slack` of
    each other agree. Where `share` of the looked-up words (two at least, if there are two) agree, the beginning that most of them name is one.
    """
    spark = files.sparkSession
    positions = spark.createDataFrame([(t, w, p, idf[w]) for t, (_, text, _) in enumerate(templates) for p, w in enumerate(words_of(text))], "template int, word string, p int, idf double")
    kinds = positions.select("template", "word", "idf").distinct()
    vocabulary = _strings(sorted(idf))
    kept = F.filter(F.transform("tokens", lambda w, i: F.struct(w.alias("word"), i.alias("i"))), lambda o: F.array_contains(F.col("own"), o["word"]))
    places = files.withColumn("own", F.array_intersect("tokens", vocabulary)).select("key", "maybe", F.explode(kept).alias("o")).select("key", "maybe", "o.word", "o.i")
    own = places.select("key", "word", F.explode("maybe").alias("template")).distinct().join(F.broadcast(kinds), ["template", "word"])
    ranked = own.withColumn("_rank", F.row_number().over(W.partitionBy("key", "template").orderBy(F.desc("idf"), "word"))).filter(F.col("_rank") <= most_rare)
    rare = ranked.withColumn("words", F.count("*").over(W.partitionBy("key", "template"))).select("key", "template", "word", "words")
    begun = places.select("key", "word", "i").join(rare, ["key", "word"]).join(F.broadcast(positions.select("template", "word", "p")), ["template", "word"]).withColumn("start", F.col("i") - F.col("p"))
    step = F.floor(F.col("start") / slack)
    near = begun.withColumn("_g", F.explode(F.array(step, step + 1)))
    by_start = near.groupBy("key", "template", "words", "_g", "start").agg(F.collect_set("word").alias("named"))
    agreed = by_start.groupBy("key", "template", "words", "_g").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("named")))).alias("support"), F.min_by("start", F.struct(-F.size("named"), "start")).alias("start")
    )
    need = F.greatest(F.ceil(F.col("words") * share), F.least(F.lit(2), F.col("words")))
    return agreed.filter(F.col("support") >= need).select("key", "template", "start").distinct()


def verified(found: DataFrame, files: DataFrame, templates, idf: dict[str, float], slack: int, coverage: float) -> DataFrame:
    """(key, matches): the label, start and coverage of each alignment whose stretch of the file holds the licence.

    The stretch is the template's length with `slack` words more on both sides. Every mandatory phrase must stand in it whole,
    and words of the template that make up `coverage` of its IDF.
    """
    texts = [words_of(text) for _, text, _ in templates]
    length = F.array(*(F.lit(len(t)) for t in texts))
    kinds = F.array(*(_strings(sorted(set(t))) for t in texts))
    total = F.array(*(F.lit(float(sum(idf[w] for w in set(t)))) for t in texts))
    phrases = F.array(*(F.array(*(F.lit(f" {p} ") for p in own)) for _, _, own in templates))
    labels = F.array(*(F.lit(label) for label, _, _ in templates))
    order = sorted(idf)
    worth = F.map_from_arrays(_strings(order), F.split(F.lit(" ".join(repr(idf[w]) for w in order)), " ").cast("array<double>"))

    def checked(c: Column) -> Column:
        t = c["template"] + 1
        begin = F.greatest(c["start"] - slack, F.lit(0))
        stretch = F.slice("tokens", begin + 1, F.greatest(c["start"] + F.element_at(length, t) + slack - begin, F.lit(0)))
        held = F.aggregate(F.array_intersect(stretch, F.element_at(kinds, t)), F.lit(0.0), lambda a, w: a + F.element_at(worth, w))
        said = F.concat(F.lit(" "), F.array_join(stretch, " "), F.lit(" "))
        whole = F.forall(F.element_at(phrases, t), lambda p: F.contains(said, p))
        return F.struct(F.element_at(labels, t).alias("label"), c["start"].cast("long").alias("start"), F.least(held / F.element_at(total, t), F.lit(1.0)).alias("coverage"), whole.alias("whole"))

    by_file = found.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "template"))).alias("_found"))
    made = files.join(by_file, "key").select("key", F.filter(F.transform("_found", checked), lambda m: m["whole"] & (m["coverage"] >= coverage)).alias("_m"))
    return made.select("key", F.transform("_m", lambda m: F.struct(m["label"].alias("label"), m["start"].alias("start"), m["coverage"].alias("coverage"))).alias("matches"))


def scan(docs: DataFrame, templates=TEMPLATES, coverage: float = 0.8, most_rare: int = 8, slack: int = 8, share: float = 0.5) -> DataFrame:
    """Licence labels of every document of `docs` (doc_id, text).

    Returns doc_id, n_words, n_base (all places of base phrases), first_word and last_word (smallest and largest
    start, from 0; null for none), base_labels and labels (comma-joined, distinct, sorted), score (1 for a base
    label, else the best coverage of a template by IDF, 0 to 1) and matches (label, start and coverage of each
    alignment that is verified). Null and empty texts have no word; very long texts are scanned whole, their places as rows;
    ties of IDF go by word, ties of support by place; repeated rows are scanned each, equal texts aligned once; other
    columns are ignored, whatever their names; an empty table gives no rows.

    IDF comes from all documents. A file that holds all words of a template's mandatory phrases is looked up by its rarest licence
    words (`alignments`), and what they agree on is compared with the text (`verified`).
    """
    tokens = F.filter(F.split(_small(F.coalesce(F.col("text"), F.lit(""))), NOT_WORD), lambda w: w != "")
    split = docs.select("doc_id", "text", tokens.alias("tokens"))
    vocabulary = sorted({w for _, text, _ in templates for w in words_of(text)})
    df, n = document_frequencies(split, vocabulary)
    idf = {w: round(math.log((n + 1) / (df[w] + 1)) + 1e-3, 9) for w in vocabulary}
    needed = [sorted({w for p in phrases for w in p.split()}) for _, _, phrases in templates]
    looked_up = _strings(sorted({w for own in needed for w in own} | {p.split()[0] for p in BASE}))
    maybe = F.filter(F.array(*(F.when(F.forall(_strings(own), lambda w: F.array_contains(F.col("_held"), w)), F.lit(t)) for t, own in enumerate(needed))), lambda t: t.isNotNull())
    none = F.array().cast("array<int>")
    first = split.withColumn("_held", F.array_intersect("tokens", looked_up))
    some = F.size("_held") > 0
    base = F.struct(*(_base_places(F.col("tokens"), phrase).alias(label) for phrase, label in BASE.items()))
    read = first.select(
        "doc_id", F.size("tokens").cast("long").alias("n_words"), F.when(some, base).otherwise(F.struct(*(none.alias(label) for label in BASE.values()))).alias("base"),
        F.when(some, maybe).otherwise(none).alias("maybe"), F.when(some, F.col("tokens")).alias("tokens"), "text",
    )
    asked = F.size("maybe") > 0
    read = staged(read.select("doc_id", "n_words", "base", "maybe", F.when(asked, F.col("tokens")).alias("tokens"), F.when(asked, F.sha1("text")).alias("key")), "licences")
    files = staged(read.filter("key is not null").select("key", "maybe", "tokens").dropDuplicates(["key"]), "files")
    found = verified(alignments(files, templates, idf, most_rare, slack, share), files, templates, idf, slack, coverage)
    columns = ("doc_id", "n_words", "base")
    empty = F.array().cast("array<struct<label:string,start:bigint,coverage:double>>")
    held = read.filter("key is not null").select(*columns, "key").join(found, "key", "left").select(*columns, F.coalesce("matches", empty).alias("matches"))
    joined = read.filter("key is null").select(*columns, empty.alias("matches")).unionByName(held)
    starts = F.concat(*(F.col("base")[label] for label in BASE.values()))
    base_labels = F.array_compact(F.array(*(F.when(F.size(F.col("base")[label]) > 0, F.lit(label)) for label in sorted(BASE.values()))))
    own = F.transform("matches", lambda m: m["label"])
    return joined.select(
        "doc_id", "n_words", F.size(starts).cast("long").alias("n_base"), F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        F.array_join(base_labels, ",").alias("base_labels"), F.array_join(F.array_sort(F.array_union(base_labels, own)), ",").alias("labels"),
        F.when(F.size(base_labels) > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max(F.transform("matches", lambda m: m["coverage"])), F.lit(0.0))).alias("score"), "matches",
    )
