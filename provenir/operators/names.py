"""Which company names a name is like: substring candidates by an index of letter groups, token-set scores in bounded tiles."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import WHITE, _indel_similarity
from ..staging import staged

GRAM, TOKEN = 3, 50
WILD = ["%", *("_" * k for k in range(1, TOKEN + 1))]


def first_token(name: str | None) -> str | None:
    """The first word of a name, case-folded and cut to `TOKEN` code points; None for none."""
    words = (name or "").casefold().split()
    return words[0][:TOKEN] if words else None


@F.pandas_udf(T.StructType().add("token", "string").add("piece", "string"))
def sought(name: pd.Series) -> pd.DataFrame:
    """The first token of a name, and its longest piece without a wildcard of LIKE.

    Where it has none, the piece is empty and the token one of `WILD` of equal meaning: so many letters at least.
    """
    tokens = [first_token(n) for n in name]
    pieces = [None if t is None else max(re.split("[%_]", t), key=len) for t in tokens]
    return pd.DataFrame({"token": [WILD[t.count("_")] if p == "" else t for t, p in zip(tokens, pieces)], "piece": pieces})


def like(token: str) -> Callable[[str], bool]:
    """Whether a text holds `token` as LIKE '%token%' has it: % stands for any text, _ for one letter."""
    if not re.search("[%_]", token):
        return lambda text: token in text
    pattern = re.compile("".join(".*" if c == "%" else "." if c == "_" else re.escape(c) for c in token), re.DOTALL)
    return lambda text: pattern.search(text) is not None


def _bags(texts: list[str], most: dict[str, int]) -> np.ndarray:
    """Letters of each text as marks: the n-th of a letter has a column of its own, so that products count shared letters."""
    start, width = {}, 0
    for c, n in most.items():
        start[c], width = width, width + n
    made = np.zeros((len(texts), width), dtype=np.float32)
    for i, text in enumerate(texts):
        for c, n in Counter(text).items():
            made[i, start[c] : start[c] + n] = 1
    return made


def similar(left: list[str], right: list[str], least: float, allowed: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, score) of the pairs whose token-set similarity is `least` or more, among those `allowed`.

    Scores of shared words alone are exact from counts. The score of the whole word lists is bounded by the letters they share,
    whatever their order, and computed only where the bound allows more than the shared words give.
    """
    sets = [[sorted(set(t.split())) for t in side] for side in (left, right)]
    # words that only one side has are shared by no pair
    words = {w: k for k, w in enumerate(sorted({w for t in sets[0] for w in t} & {w for t in sets[1] for w in t}))}
    held = [np.zeros((len(side), len(words)), dtype=np.float32) for side in sets]
    for matrix, side in zip(held, sets):
        for i, tokens in enumerate(side):
            matrix[i, [words[w] for w in tokens if w in words]] = 1
    long = np.array([len(w) for w in words], dtype=np.float32)
    shared = held[0] @ held[1].T
    common = (held[0] * long) @ held[1].T + np.maximum(shared - 1, 0)
    joined = [[" ".join(tokens) for tokens in side] for side in sets]
    size = [np.array([len(t) for t in side], dtype=np.float64) for side in joined]
    number = [np.array([len(tokens) for tokens in side]) for side in sets]
    filled = (number[0] > 0)[:, None] & (number[1] > 0)[None, :]
    with np.errstate(invalid="ignore", divide="ignore"):
        part = np.maximum(200 * common / (common + size[0][:, None]), 200 * common / (common + size[1][None, :]))
    inside = (shared > 0) & ((shared == number[0][:, None]) | (shared == number[1][None, :]))
    score = np.where(shared > 0, np.where(inside, 100.0, part), 0.0)
    score[~filled] = 0.0
    letters: Counter = Counter()
    for side in joined:
        for text in side:
            letters |= Counter(text)
    bags = [_bags(side, letters) for side in joined]
    most = bags[0] @ bags[1].T
    bound = 200 * most / np.maximum(size[0][:, None] + size[1][None, :], 1)
    may = filled & (bound >= least) & (bound > score) & ~inside
    if allowed is not None:
        may &= allowed
        score = np.where(allowed, score, 0.0)
    for i, j in zip(*np.nonzero(may)):
        both = set(sets[0][i]) & set(sets[1][j])
        one, two = (" ".join([*sorted(both), *(w for w in side if w not in both)]) for side in (sets[0][i], sets[1][j]))
        score[i, j] = max(score[i, j], _indel_similarity(one, two))
    row, column = np.nonzero(score >= least)
    return row, column, score[row, column]


def _scored(least: float, earliest: bool) -> Callable[[pa.Table], pa.Table]:
    """For each name that asks in a pool: its best name there (or, `earliest`, its first) of `least` or more."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        groups: dict[tuple, tuple[list, list]] = defaultdict(lambda: ([], []))
        for r in rows:
            groups[r["token"], r["a"], r["b"]][0 if r["asks"] else 1].append(r)
        found = []
        for (token, _, _), (asking, names) in groups.items():
            names = list({r["id"]: r for r in names}.values())
            matches = like(token)
            names = [r for r in names if matches(r["hay"])]
            if not names or not asking:
                continue
            before = np.array([r["seen"] for r in names])[None, :] < np.array([r["seen"] for r in asking])[:, None]
            i, j, score = similar([r["name_key"] for r in asking], [r["name_key"] for r in names], least, before)
            best: dict[int, tuple] = {}
            for a, b, s in zip(i.tolist(), j.tolist(), score.tolist()):
                place = (names[b]["seen"], names[b]["id"])
                now = (place, -s) if earliest else (-s, place)
                if a not in best or now < best[a][0]:
                    best[a] = now, names[b]["id"], names[b]["seen"], s
            found += [(asking[a]["id"], other, seen, s) for a, (_, other, seen, s) in best.items()]
        ids, others, seen, scores = zip(*found) if found else ((), (), (), ())
        return pa.table({"id": pa.array(ids, pa.string()), "other": pa.array(others, pa.string()), "other_seen": pa.array(seen, pa.int64()), "score": pa.array(scores, pa.float64())})

    return run


def _words(names: DataFrame) -> DataFrame:
    """(word, id): the words of each name's haystack."""
    return names.select("id", F.explode(F.array_distinct(F.filter(F.split("hay", WHITE), lambda w: w != ""))).alias("word"))


def _grams(word: str, size: int) -> Column:
    return F.expr(f"transform(sequence(1, greatest(length({word}) - {size - 1}, 1)), k -> substring({word}, k, {size}))")


def held_in(pieces: DataFrame, words: DataFrame) -> DataFrame:
    """(piece, word) for the `words` (word) that hold one of the `pieces` (piece), by an inverted index of letter groups.

    Words are listed under their groups of one to `GRAM` letters. A piece is looked up under its rarest group of `GRAM` letters,
    or itself if it is shorter, and then compared.
    """
    listed = words.distinct().withColumn("gram", F.explode(F.array_distinct(F.flatten(F.array(*(_grams("word", k) for k in range(1, GRAM + 1)))))))
    loads = listed.groupBy("gram").agg(F.count("*").alias("load"))
    asked = pieces.distinct().withColumn("gram", F.explode(F.when(F.length("piece") < GRAM, F.array("piece")).otherwise(F.array_distinct(_grams("piece", GRAM)))))
    weighed = asked.join(loads, "gram", "left").groupBy("piece").agg(F.min_by("gram", F.struct(F.coalesce("load", F.lit(0)), "gram")).alias("gram"))
    return weighed.join(listed, "gram").filter(F.contains("word", "piece")).select("piece", "word")


def matches(asked: DataFrame, names: DataFrame, least: float, earliest: bool = False, tile_rows: int = 1000) -> DataFrame:
    """(id, other, other_seen, score): for each of `asked` the name of `names` that is most like it (the one seen first among
    equals; with `earliest` simply the first), if its score is `least` or more.

    Both have id, name_key and seen (long); `asked` has token and piece besides (`sought`), `names` has hay, the text that must hold the
    token. Only names with a smaller `seen` count. Names meet by token; a token with more than `tile_rows` names on a side is cut
    into tiles, and small ones are pooled, so that a task holds a bounded number of names whatever their words. No pair
    leaves a tile, only the best of each name.
    """
    words = _words(names)
    tokens = asked.select("token", "piece").distinct()
    literal = held_in(tokens.filter("piece <> ''").select("piece"), words.select("word"))
    by_word = tokens.join(literal, "piece").select("token", "word").join(words, "word").select("token", "id")
    wild = sorted(r[0] for r in tokens.filter("piece = ''").select("token").collect())  # a few of `WILD`
    if wild:
        by_word = by_word.unionByName(names.select(F.explode(F.array(*map(F.lit, wild))).alias("token"), "id"))
    held = by_word.join(names.select("id", "name_key", "hay", "seen"), "id")
    right = staged(held.select("token", "id", "name_key", "hay", "seen"), "names-held")
    left = asked.join(right.select("token").distinct(), "token", "left_semi")
    tiles = lambda rows, out: rows.groupBy("token").agg(F.ceil(F.count("*") / tile_rows).cast("int").alias(out))
    shares = tiles(left, "na").join(tiles(right, "nb"), "token")
    part = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    asking = left.join(shares, "token").select("token", "id", "name_key", F.lit(None).cast("string").alias("hay"), "seen", F.lit(True).alias("asks"), part("na").alias("a"), each("nb").alias("b"))
    stored = right.join(shares, "token").select("token", "id", "name_key", "hay", "seen", F.lit(False).alias("asks"), each("na").alias("a"), part("nb").alias("b"))
    cells = asking.unionByName(stored)
    pools = max(1, -(-right.count() // (2 * tile_rows)))
    pooled = cells.withColumn("pool", F.pmod(F.xxhash64("token", "a", "b"), F.lit(4 * pools)))
    found = pooled.groupBy("pool").applyInArrow(_scored(least, earliest), "id string, other string, other_seen long, score double")
    order = F.struct("other_seen", "other", -F.col("score")) if earliest else F.struct(-F.col("score"), F.col("other_seen"), F.col("other"))
    best = found.groupBy("id").agg(F.min_by(F.struct("other", "other_seen", "score"), order).alias("best"))
    return best.select("id", "best.*")
