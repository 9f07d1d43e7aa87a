"""Companies: which known one a candidate is, and how the two merge."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ids, rules, urls
from ..functions.text import clean_text, first_truthy, normal_form, normalize_text, token_set_similarity, truthy
from ..staging import staged
from .names import matches, sought

MERGE_AT, REVIEW_AT = 96, 84
#: Companies that a batch makes are seen after all known ones, in the order of the batch.
BATCH, UNDATED = 1 << 62, 1 << 61


def prepared(candidates: DataFrame) -> DataFrame:
    """Candidates with canonical website, domain, name key and the id a new company would get."""
    site = urls.canonical_url(F.col("website"))
    based = candidates.withColumn("website", site).withColumn("domain", urls.domain_of(F.col("website"))).withColumn("name_key", normalize_text("name"))
    material = first_truthy(F.col("domain"), F.col("external_id"), F.col("name"))
    return based.withColumn("new_id", ids.stable_id("company", normalize_text(material), normalize_text(F.coalesce("country", F.lit("")))))


def _founders(asked: DataFrame, names: DataFrame) -> DataFrame:
    """(id): those of `asked` (and `names`, the same as names) that are companies of their own, taken in order of `seen`:
    whose names are like (`MERGE_AT`) none of an earlier founder.

    Rounds of local minima: who has no earlier open name like its own is a founder, who is like a founder is settled, the
    rest is looked at again. A round compares open names only.
    """
    founders, open_ = [], asked
    while True:
        waits = staged(matches(open_, names.join(open_.select("id"), "id", "left_semi"), MERGE_AT, earliest=True).select("id"), "waits")
        first = staged(open_.join(waits, "id", "left_anti").select("id"), "founders")
        founders.append(first)
        if waits.isEmpty():
            return reduce(DataFrame.unionByName, founders)
        later = open_.join(waits, "id", "left_semi")
        like = matches(later, names.join(first, "id", "left_semi"), MERGE_AT, earliest=True).select("id")
        open_ = staged(later.join(like, "id", "left_anti"), "open")
        if open_.isEmpty():
            return reduce(DataFrame.unionByName, founders)


def resolve(existing: DataFrame, candidates: DataFrame) -> DataFrame:
    """pos, company_id, is_new, needs_review and score for each of `candidates` (COMPANY_CANDIDATE and pos).

    A known domain decides (oldest company first); candidates of one unknown domain follow the first of them. Else the name is compared
    with every company whose name holds the candidate's first word anywhere (with the wildcards of LIKE): the most similar
    one (the oldest of equals) is taken at 96 or more; at 84 or more the candidate is a new company that awaits review.
    The order within a batch is `pos`: a candidate sees the companies that earlier ones made. The score is that of the
    most similar company, 0 below 84.

    Nothing is gathered by company or word: names meet in bounded tiles (`names.matches`), and which candidates
    make companies is settled in rounds (`_founders`). Equal names are compared once, by the first of them.
    """
    ready = staged(prepared(candidates).select("pos", "domain", "name_key", "new_id", clean_text(F.col("name"), 300).alias("canonical"), "name", sought("name").alias("s")), "candidates")
    oldest = F.min_by("company_id", F.struct(F.col("first_seen_at").isNull(), "first_seen_at", "company_id")).alias("known_id")
    by_domain = existing.filter("domain is not null").groupBy("domain").agg(oldest)
    leaders = ready.filter("domain is not null").groupBy("domain").agg(F.min("pos").alias("leader"))
    led = ready.join(by_domain, "domain", "left").join(leaders, "domain", "left").withColumn("leader", F.coalesce("leader", "pos"))
    settled = lambda rows: rows.select("pos", "company_id", F.lit(False).alias("is_new"), F.lit(False).alias("needs_review"), F.lit(100.0).alias("score"))
    found = settled(led.filter("known_id is not null").withColumn("company_id", F.col("known_id")))
    own = F.coalesce("canonical", "name")
    # the name as it is compared: normal form of the name a company made of it would have
    asked = staged(
        led.filter("known_id is null and pos = leader").select(F.col("pos").cast("string").alias("id"), "pos", "new_id", "name_key", "s.token", "s.piece", (F.col("pos") + BATCH).alias("seen"), F.lower(own).alias("hay"), normalize_text(own).alias("own_key")), "asked"
    )
    # equal names follow the first of them, where a name is sure to meet itself
    meets = F.coalesce((F.col("own_key") == F.col("name_key")) & ((F.col("piece") == "") | F.contains("hay", "token")), F.lit(False))
    first = asked.filter(meets).groupBy("hay", "name_key", "token").agg(F.min("pos").alias("rep"))
    ranked = staged(asked.filter(meets).join(first, ["hay", "name_key", "token"]).select(*asked.columns, "rep").unionByName(asked.filter(~meets).withColumn("rep", F.col("pos"))), "ranked")
    reps = ranked.filter("pos = rep")
    old = existing.filter("canonical_name is not null").select(F.col("company_id").alias("id"), normalize_text("canonical_name").alias("name_key"), F.lower("canonical_name").alias("hay"), F.coalesce(F.unix_micros("first_seen_at"), F.lit(UNDATED)).alias("seen"))
    old = old.groupBy("name_key", "hay").agg(F.min(F.struct("seen", "id")).alias("oldest")).select("oldest.*", "name_key", "hay")  # of equal names only the oldest is ever taken
    known = staged(matches(reps.filter("token is not null"), old, REVIEW_AT), "known")
    merged = known.filter(F.col("score") >= MERGE_AT).select("id")
    made = reps.select("id", F.col("own_key").alias("name_key"), "hay", "seen")
    open_ = staged(reps.join(merged, "id", "left_anti"), "open")
    alone = open_.filter("token is null").select("id")
    founders = staged(_founders(open_.filter("token is not null"), made).unionByName(alone), "founders")
    fresh = made.join(founders, "id", "left_semi")
    news = matches(reps.filter("token is not null"), fresh, REVIEW_AT)
    placed = staged(_best(reps, known, news), "placed")
    # a repeated name follows the first of its kind, unless a later company may be more like it
    others = ranked.filter("pos <> rep").join(placed.select(F.col("pos").alias("rep"), F.col("is_new").alias("led_new"), F.col("other").alias("led"), F.col("score").alias("led_score"), F.col("own_id").alias("led_id")), "rep")
    follows = others.filter("led_new or led_score = 100").select("pos", F.when(F.col("led_new"), F.concat(F.lit("new:"), F.col("led_id"))).otherwise(F.col("led")).alias("other"), F.lit(False).alias("is_new"), F.lit(False).alias("needs_review"), F.lit(100.0).alias("score"))
    again = others.filter("not led_new and led_score < 100").drop("led_new", "led", "led_score", "led_id")
    if not again.isEmpty():
        seen = known.join(ranked.select(F.col("pos").cast("string").alias("of"), F.col("rep").cast("string").alias("id")), "id").filter("of <> id").select(F.col("of").alias("id"), "other", "other_seen", "score")
        later = _best(again, seen, matches(again, fresh, REVIEW_AT)).select(*follows.columns)
        follows = follows.unionByName(later)
    chosen = placed.select(*follows.columns).unionByName(follows)
    ids_of = asked.select(F.concat(F.lit("new:"), "id").alias("other"), F.col("new_id"))
    named = staged(chosen.join(ids_of, "other", "left").select("pos", F.coalesce("new_id", "other").alias("company_id"), "is_new", "needs_review", "score"), "named")
    followers = led.filter("known_id is null and pos <> leader").select("pos", "leader")
    followed = settled(followers.join(named.select(F.col("pos").alias("leader"), "company_id"), "leader"))
    return found.unionByName(named).unionByName(followed)


def _best(asked: DataFrame, known: DataFrame, news: DataFrame) -> DataFrame:
    """pos, own_id, other, is_new, needs_review, score: what each of `asked` becomes, given its most similar known company and its most similar
    new one. Companies that the batch makes are told as new:<id>."""
    both = known.unionByName(news.withColumn("other", F.concat(F.lit("new:"), "other")))
    best = both.groupBy("id").agg(F.min_by(F.struct("other", "score"), F.struct(-F.col("score"), F.col("other_seen"), F.col("other"))).alias("best"))
    joined = asked.join(best, "id", "left").select("pos", F.col("id").alias("own_id"), F.col("best.other").alias("match"), F.coalesce("best.score", F.lit(0.0)).alias("score"))
    is_new = F.col("score") < MERGE_AT
    return joined.select("pos", "own_id", F.when(is_new, F.concat(F.lit("new:"), "own_id")).otherwise(F.col("match")).alias("other"), is_new.alias("is_new"), (is_new & (F.col("score") >= REVIEW_AT)).alias("needs_review"), "score")


def _last(column: str) -> Column:
    """The last filled value by pos."""
    return F.max_by(column, F.when(truthy(F.col(column)).isNotNull(), F.col("pos"))).alias(column)


def merge(existing: DataFrame, resolved: DataFrame) -> DataFrame:
    """The companies that `resolved` (prepared candidates with pos and company_id) change, after the change.

    Name, first sight and primary source stay those of the first row; other names become aliases; lists unite;
    scalars take the last filled value, relationship the last that is known; confidence and last sight the largest.
    Everything is one aggregate by company.
    """
    known = existing.join(resolved.select("company_id").distinct(), "company_id", "left_semi").withColumn("pos", F.lit(-1).cast("long"))
    fresh = resolved.select(
        "company_id", clean_text(F.col("name"), 300).alias("canonical_name"), clean_text(F.col("legal_name"), 300).alias("legal_name"), "aliases", "domain", "website",
        urls.canonical_url(F.col("careers_url")).alias("careers_url"), "sectors", "nepal_relationship", clean_text(F.col("country"), 100).alias("country"),
        clean_text(F.col("locality"), 200).alias("locality"), clean_text(F.col("address"), 500).alias("address"),
        rules.organization_email(F.col("official_email"), F.col("domain")).alias("official_email"), clean_text(F.col("official_phone"), 100).alias("official_phone"),
        clean_text(F.col("profile"), 1000).alias("profile"), F.lit(True).alias("active"), "confidence", F.col("observed_at").alias("first_seen_at"), F.col("observed_at").alias("last_seen_at"),
        F.col("source_id").alias("primary_source_id"), F.col("source_url").alias("primary_source_url"), "pos",
    )
    rows = known.unionByName(fresh.select(*known.columns))
    first = lambda c: F.min_by(c, "pos").alias(c)
    names = F.array_union(F.flatten(F.collect_list(F.coalesce("aliases", F.array().cast("array<string>")))), F.collect_list("canonical_name"))
    relation = F.coalesce(F.max_by("nepal_relationship", F.when(F.col("nepal_relationship") != "unknown", F.col("pos"))), F.lit("unknown"))
    sectors = F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.coalesce("sectors", F.array().cast("array<string>"))))))
    scalars = ["legal_name", "domain", "website", "careers_url", "country", "locality", "address", "official_email", "official_phone", "profile"]
    merged = rows.groupBy("company_id").agg(
        first("canonical_name"), names.alias("_names"), sectors.alias("sectors"), relation.alias("nepal_relationship"), *(_last(c) for c in scalars), F.lit(True).alias("active"),
        F.max("confidence").alias("confidence"), first("first_seen_at"), F.max("last_seen_at").alias("last_seen_at"), first("primary_source_id"), first("primary_source_url"),
    )
    aliases = F.array_sort(F.filter("_names", lambda n: (n != "") & (n != F.col("canonical_name"))))
    return merged.withColumn("aliases", aliases).select(*existing.columns)


def same_company(a: str, b: str) -> float:
    """Score of two names, as `resolve` compares them."""
    return token_set_similarity(normal_form(a), normal_form(b))
