"""Mixing sources to target weights: multinomial counts per shard, slots mapped to blocks by permutations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from .common import SPACE, salts_for, staged, words

ROUNDS = 16


def _source_key(source: Column) -> Column:
    """A text that sorts as the sources do by code point, null last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


def ranked(rows: DataFrame, column: str, each: int = 100_000) -> DataFrame:
    """`rows` with `part` and `pos`: where a row stands in the order of `column`, counted within ranges of about `each` rows."""
    parts = max(1, -(-rows.count() // each))
    dealt = staged(rows.repartitionByRange(parts, column).withColumn("part", F.spark_partition_id()), "ranked")
    return dealt.withColumn("pos", F.row_number().over(W.partitionBy("part").orderBy(column)) - 1)


def running(rows: DataFrame, value: Column, out: str) -> DataFrame:
    """`out`: the sum of `value` over all `rows` (part, pos, as `ranked` gives them) that stand before a row."""
    valued = rows.withColumn("_v", value)
    inner = F.coalesce(F.sum("_v").over(W.partitionBy("part").orderBy("pos").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    # one row a part, so one in about 100,000 of `rows`
    earlier = W.partitionBy(F.lit(0)).orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    shift = valued.groupBy("part").agg(F.sum("_v").alias("_s")).select("part", F.coalesce(F.sum("_s").over(earlier), F.lit(0)).alias("_before"))
    return valued.withColumn("_inner", inner).join(shift, "part").withColumn(out, F.col("_before") + F.col("_inner")).drop("_v", "_inner", "_before")


def targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most_repeats: int = 3) -> DataFrame:
    """Words each source is to give: `sizes` (source_key, source_size, one row a source) with part, pos and `target`.

    Weights go to sources in order and repeat. The targets share all words by weight; a source stops at
    `most_repeats` times its size and the excess is shared among the others by weight, until none is above. The level of
    the others only rises, so it is found by a few sums over the sources.
    """
    placed = running(ranked(sizes, "source_key"), F.lit(1), "_nth")
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("_nth") % len(weights) + 1).cast("int"))
    rows = staged(placed.select("source_key", "source_size", "part", "pos", weight.alias("weight")), "weights")
    level, stopped = 0.0, -1
    while True:
        stops = (F.lit(level) * F.col("weight") >= most_repeats * F.col("source_size")) if stopped >= 0 else F.lit(False)
        found = rows.agg(F.count_if(stops).alias("n"), F.sum("source_size").alias("all"), F.sum(F.when(stops, F.col("source_size")).otherwise(0)).alias("full"), F.sum(F.when(~stops, F.col("weight"))).alias("open")).first()
        if found["n"] == stopped or not found["open"]:
            break
        level, stopped = (found["all"] - most_repeats * found["full"]) / found["open"], found["n"]
    share = F.lit(level) * F.col("weight")
    return rows.select("source_key", "source_size", "part", "pos", F.least(share, (most_repeats * F.col("source_size")).cast("double")).alias("target"))


def permuted(index: Column, count: Column, *key: Column) -> Column:
    """A pseudorandom permutation of 0..count-1, keyed: the swap-or-not shuffle, exact for any count and without state."""

    def swap(x: Column, i: Column) -> Column:
        mirror = F.pmod(F.pmod(F.xxhash64(*key, i), count) - x + count, count)
        return F.when(F.xxhash64(*key, i, F.greatest(x, mirror)).bitwiseAND(F.lit(1)) == 1, mirror).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), index, swap)


def placed(docs: DataFrame, seed: int) -> DataFrame:
    """`docs` (source_key, doc_id, size, order_key, ...) with `begin`, the first word of each in its source's stream.

    A source's documents are dealt over buckets by a hash; sums within a bucket are shifted by the buckets before
    it, so no source is gathered in one task.
    """
    salts = salts_for(docs.count())
    dealt = docs.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "order_key", F.lit(seed)), F.lit(salts)))
    before = lambda *by: W.partitionBy(*by).rowsBetween(W.unboundedPreceding, -1)
    inner = F.coalesce(F.sum("size").over(before("source_key", "_salt").orderBy("order_key", "doc_id")), F.lit(0))
    shift = dealt.groupBy("source_key", "_salt").agg(F.sum("size").alias("_words")).select(
        "source_key", "_salt", F.coalesce(F.sum("_words").over(before("source_key").orderBy("_salt")), F.lit(0)).alias("_shift")
    )
    return dealt.withColumn("_inner", inner).join(shift, ["source_key", "_salt"]).withColumn("begin", F.col("_shift") + F.col("_inner")).drop("_salt", "_inner", "_shift")


def _sources_of(tickets: DataFrame, ends: DataFrame, total: int, sources: int) -> DataFrame:
    """`tickets` (ticket, ...) with the source_key whose interval [low, high) of `ends` holds the ticket.

    Intervals are looked up by equal cells of [0, total), more cells than sources. They are broadcast while they are few.
    """
    cells = max(1024, 4 * sources)
    cell = lambda x: F.floor(x * F.lit(cells / total)).cast("int")
    near = ends.filter("high > low").withColumn("_cell", F.explode(F.sequence(cell(F.col("low")), cell(F.col("high")))))
    small = sources + cells <= 200_000
    return tickets.withColumn("_cell", cell(F.col("ticket"))).join(F.broadcast(near) if small else near, "_cell").filter("ticket >= low and ticket < high").drop("_cell", "low", "high")


def _earlier(rows: DataFrame, key: str, order: str, value: str, out: str, width: int = 1000) -> DataFrame:
    """`out`: the sum of `value` over the rows of a key with a smaller `order`, by groups of `width` orders, so that no window is long."""
    before = lambda *by: W.partitionBy(*by).rowsBetween(W.unboundedPreceding, -1)
    grouped = rows.withColumn("_g", F.floor(F.col(order) / width))
    inner = F.coalesce(F.sum(value).over(before(key, "_g").orderBy(order)), F.lit(0))
    shift = grouped.groupBy(key, "_g").agg(F.sum(value).alias("_n")).select(key, "_g", F.coalesce(F.sum("_n").over(before(key).orderBy("_g")), F.lit(0)).alias("_shift"))
    return grouped.withColumn("_inner", inner).join(shift, [key, "_g"]).withColumn(out, F.col("_shift") + F.col("_inner")).drop("_g", "_inner", "_shift")


def slot_counts(wanted: DataFrame, shard_slots: int, seed: int) -> DataFrame:
    """Multinomial source counts per output shard: rows (shard, source_key, count, first), `first` the number of the first.

    `wanted`: source_key, part, pos and slots (long), the slots that each source fills in all. Every slot of every shard
    draws a source with a hash of its own, in proportion to the slots wanted: the counts of a shard are a multinomial
    draw. What a source draws beyond its slots, over all shards in order, stays open and is drawn again in proportion to
    what is left, until all shards are full; so each source fills its slots exactly. A round costs a pass over the open slots alone.
    """
    spark = wanted.sparkSession
    sized = wanted.agg(F.sum("slots").alias("all"), F.count("*").alias("n")).first()
    total, sources = sized["all"] or 0, sized["n"]
    shards = -(-total // shard_slots)
    rooms = spark.range(0, shards, 1, max(1, -(-shards // 256))).select(F.col("id").alias("shard"), F.least(F.lit(shard_slots), F.lit(total) - F.col("id") * shard_slots).alias("room"))
    found = spark.createDataFrame([], "shard long, source_key string, count long, first long")
    left, turn = total, 0
    while left:
        filled = found.groupBy("source_key").agg(F.sum("count").alias("used"))
        open_sources = wanted.join(filled, "source_key", "left").withColumn("used", F.coalesce("used", F.lit(0))).withColumn("need", F.col("slots") - F.col("used"))
        needs = staged(running(open_sources, F.col("need"), "low").select("source_key", "used", "need", "low", (F.col("low") + F.col("need")).alias("high")), "needs")
        taken = found.groupBy("shard").agg(F.sum("count").alias("taken"))
        free = rooms if not turn else rooms.join(taken, "shard", "left").select("shard", (F.col("room") - F.coalesce("taken", F.lit(0))).alias("room")).filter("room > 0")
        slots = free.select("shard", F.explode(F.sequence(F.lit(1).cast("long"), F.col("room"))).alias("i"))
        tickets = slots.select("shard", F.pmod(F.xxhash64(F.lit(seed), F.lit(turn), "shard", "i"), F.lit(left).cast("long")).alias("ticket"))
        drawn = _sources_of(tickets, needs.select("source_key", "low", "high"), left, sources).groupBy("shard", "source_key").count()
        numbered = _earlier(drawn, "source_key", "shard", "count", "before").join(needs.select("source_key", "used", "need"), "source_key")
        kept = F.greatest(F.lit(0), F.least(F.col("count"), F.col("need") - F.col("before"))).cast("long")
        made = staged(numbered.select("shard", "source_key", kept.alias("count"), (F.col("used") + F.col("before")).cast("long").alias("first")).filter("count > 0"), "counts")
        found, turn = found.unionByName(made), turn + 1
        left -= made.agg(F.sum("count")).first()[0] or 0
    return found


def mix(docs: DataFrame, block: int = 32, shard_slots: int = 4096, most_repeats: int = 3, seed: int = 1, weights: tuple[float, ...] = (5, 2, 1)) -> tuple[DataFrame, DataFrame]:
    """Mixes `docs` (doc_id, text, source) by words to target weights: (documents, pieces).

    documents: doc_id, order_key (a hash of the text), source, source_key, copy, size, source_size, target, taken.
    pieces: shard, slot, source_key, doc_id, order_key, copy, first_word, n_words: what each output slot holds, in order.

    The words of a source, in an order of its own, are cut into blocks of `block`; a shard has `shard_slots` slots, and
    draws how many each source fills (`slot_counts`). The k-th slot of a source takes the block that a keyed permutation
    maps k (modulo the blocks) to, so each block is taken equally often or once more, and never more than `most_repeats`
    times. Null and blank texts have size 0 and are never taken; very long texts are cut like any other; a null source
    is a source, last in order; rows that share doc_id, text and source are documents of their own, told apart by
    `copy` (from 0); ties of order go by hash and doc_id; other columns are ignored, whatever their names; an empty table
    gives no rows. Reruns agree.
    """
    rows = docs.select("doc_id", F.coalesce(F.xxhash64("text"), F.lit(0).cast("long")).alias("order_key"), "source", _source_key(F.col("source")).alias("source_key"),
                       F.size(words(F.coalesce("text", F.lit("")))).cast("long").alias("size"))
    sized = staged(rows, "sizes")
    aimed = staged(targets(sized.groupBy("source_key").agg(F.sum("size").alias("source_size")), weights, most_repeats), "targets")
    blocks = F.ceil(F.col("source_size") / block)
    slots = F.least(F.round(F.col("target") / F.col("source_size") * F.col("blocks")), most_repeats * F.col("blocks")).cast("long")
    filled = staged(aimed.filter("source_size > 0").withColumn("blocks", blocks).withColumn("slots", slots), "wanted")
    counts = slot_counts(filled, shard_slots, seed)
    whole = filled.agg(F.sum("slots")).first()[0] or 0
    dealt = counts.repartition(max(1, -(-whole // 200_000)), "shard", "source_key")
    numbered = dealt.select("shard", "source_key", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("count") - 1)).alias("k")).join(filled.select("source_key", "blocks"), "source_key")
    slots = numbered.select("shard", "k", "source_key", permuted(F.pmod("k", "blocks"), F.col("blocks"), F.lit(seed), F.col("source_key")).alias("block_index"))

    alike = sized.groupBy("source_key", "doc_id", "order_key").agg(F.count("*").alias("_n"), F.first("source").alias("source"), F.first("size").alias("size"))
    begun = placed(alike.withColumn("_one", F.col("size")).withColumn("size", F.col("size") * F.col("_n")), seed)
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)).alias("copy")
    streams = staged(begun.select("source_key", "doc_id", "order_key", "source", F.col("_one").alias("size"), "begin", copy), "streams")
    streams = streams.withColumn("begin", F.col("begin") + F.col("copy") * F.col("size"))
    last = F.floor((F.col("begin") + F.col("size") - 1) / block)
    spans = streams.filter("size > 0").withColumn("block_index", F.explode(F.sequence(F.floor(F.col("begin") / block), last)))
    first_word = F.greatest(F.lit(0), F.col("block_index") * block - F.col("begin"))
    end_word = F.least(F.col("size"), (F.col("block_index") + 1) * block - F.col("begin"))
    parts = spans.select("source_key", "block_index", "doc_id", "order_key", "copy", first_word.alias("first_word"), (end_word - first_word).alias("n_words"))
    pieces = parts.join(slots, ["source_key", "block_index"]).select("shard", F.col("k").alias("slot"), "source_key", *DOCUMENT[:2], "copy", "first_word", "n_words")

    uses = slots.groupBy("source_key", "block_index").agg(F.count("*").alias("uses"))
    own = (*DOCUMENT, "copy")
    given = parts.join(uses, ["source_key", "block_index"]).groupBy(*own).agg(F.sum(F.col("n_words") * F.col("uses")).alias("taken"))
    joined = streams.join(given.select(*(F.col(c).alias(f"_{c}") for c in own), "taken"), _same(own), "left")
    told = joined.join(aimed.select("source_key", "source_size", "target"), "source_key")
    return told.select("doc_id", "order_key", "source", "source_key", "copy", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")), pieces


#: What tells one document from another, but for its copies.
DOCUMENT = ("doc_id", "order_key", "source_key")


def _same(columns: tuple[str, ...]) -> Column:
    """Equal `columns` and their namesakes with an underscore, nulls too."""
    return reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, with the columns of `docs`: what `mix` says is taken, and nothing else.

    A document's words are cut as its blocks cut them; the r-th output row (r = 1, 2, 3) holds, in order, the parts that
    are taken r times or more, with the white space that follows them. Wholly taken texts come back unchanged.
    Documents of which nothing is taken go. n_chars follows the text. Rows that share doc_id, text and source get what
    each of them is given, in order of a hash of the row.
    """
    told, pieces = mix(docs, **options)
    own = (*DOCUMENT, "copy")
    parts = pieces.groupBy(*own, "first_word", "n_words").agg(F.count("*").alias("uses"))
    plan = parts.groupBy(*own).agg(F.array_sort(F.collect_list(F.struct("first_word", "n_words", "uses"))).alias("parts"))
    plan = plan.select(*(F.col(c).alias(f"_{c}") for c in own), "parts")
    keyed = docs.select("doc_id", "text", F.coalesce(F.xxhash64("text"), F.lit(0).cast("long")).alias("order_key"), _source_key(F.col("source")).alias("source_key"), F.struct("*").alias("_row"))
    if told.filter("copy > 0").isEmpty():
        keyed = keyed.withColumn("copy", F.lit(0).cast("long"))
    else:
        keyed = keyed.withColumn("copy", (F.row_number().over(W.partitionBy(*DOCUMENT).orderBy(F.xxhash64(F.to_json("_row")))) - 1).cast("long"))
    joined = keyed.join(plan, _same(own))
    pieces_of = F.split(F.regexp_replace("text", f"^{SPACE}", ""), r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")
    most = F.array_max(F.transform("parts", lambda p: p["uses"]))
    copies = joined.select("_row", "text", "parts", pieces_of.alias("_tokens"), F.explode(F.sequence(F.lit(1).cast("long"), most)).alias("_turn"))
    taken = F.filter("parts", lambda p: p["uses"] >= F.col("_turn"))
    covered = F.aggregate(taken, F.lit(0).cast("long"), lambda a, p: a + p["n_words"]) >= F.size("_tokens")
    cut = F.array_join(F.transform(taken, lambda p: F.array_join(F.slice("_tokens", (p["first_word"] + 1).cast("int"), p["n_words"].cast("int")), "")), "")
    made = copies.select("_row", F.when(covered, F.col("text")).otherwise(cut).alias("_text"))
    row = F.col("_row").withField("text", F.col("_text"))
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.length("_text").cast(docs.schema["n_chars"].dataType))
    return made.select(row.alias("_row")).select("_row.*").select(*docs.columns)
