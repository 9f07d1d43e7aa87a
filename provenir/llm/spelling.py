"""Spelling variants: half of a word matched exactly in a minimal acyclic automaton, the rest completed with one error."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_POINTS, LEAST_SEEN = 5, 3


class Automaton:
    """Minimal acyclic automaton of sorted distinct words. An edge knows how many words of its state come before those it leads
    to, so that the path of a word adds up to the word's number in the order of the words (a perfect hash)."""

    def __init__(self, words: Iterable[str]):
        #: For each state: edges (letter: next state, words before it), whether a word ends there, and the words from there on.
        self.edges: list[dict[str, tuple[int, int]]] = []
        self.final: list[bool] = []
        self.size: list[int] = []
        known: dict[tuple, int] = {}
        opened: list[list] = [[{}, False]]  # along the last word: letters to complete states, whether a word ends
        last = ""
        for word in words:
            same = 0
            while same < min(len(last), len(word)) and last[same] == word[same]:
                same += 1
            self._complete(opened, last, same, known)
            opened.extend([{}, False] for _ in word[same:])
            opened[-1][1] = True
            last = word
        self._complete(opened, last, 0, known)
        self.start = self._state(*opened[0])

    def _state(self, letters: dict[str, int], final: bool) -> int:
        before, edges = int(final), {}
        for letter, to in letters.items():
            edges[letter] = to, before
            before += self.size[to]
        self.edges.append(edges)
        self.final.append(final)
        self.size.append(before)
        return len(self.edges) - 1

    def _complete(self, opened: list[list], word: str, depth: int, known: dict[tuple, int]) -> None:
        """The states of `word` below `depth` get no more words: each is the known state of equal future, or a new one."""
        while len(opened) > depth + 1:
            letters, final = opened.pop()
            future = (final, *letters.items())
            if future not in known:
                known[future] = self._state(letters, final)
            opened[-1][0][word[len(opened) - 1]] = known[future]

    def walk(self, at: tuple[int, int] | None, letters: str) -> tuple[int, int] | None:
        """(state, words before) after `letters`; None where no word goes on so."""
        for letter in letters:
            edge = self.edges[at[0]].get(letter) if at else None
            if edge is None:
                return None
            at = edge[0], at[1] + edge[1]
        return at

    def ends(self, at: tuple[int, int] | None, letters: str) -> Iterator[int]:
        """The number of the word that `letters` complete, if there is one."""
        at = self.walk(at, letters)
        if at and self.final[at[0]]:
            yield at[1]

    def one_error(self, head: str, tail: str) -> set[int]:
        """Numbers of the words `head` + t where t differs from `tail` by exactly one inserted, deleted or replaced letter."""
        found: set[int] = set()
        at = self.walk((self.start, 0), head)
        for i in range(len(tail) + 1):
            if at is None:
                break
            rest = tail[i + 1 :]
            if i < len(tail):
                found.update(self.ends(at, rest))
            for letter, (to, before) in self.edges[at[0]].items():
                below = to, at[1] + before
                found.update(self.ends(below, tail[i:]))
                if i < len(tail) and letter != tail[i]:
                    found.update(self.ends(below, rest))
            at = self.walk(at, tail[i : i + 1])
        return found


def _near(forward: bool) -> Callable[[pa.Table], pa.Table]:
    """For the words that ask in a pool: how many stored words are near, and the most frequent of them.

    Words are stored behind a mark of the length of their half and its share, so that one which the pool has for several halves
    is met for the one asked. A pair that both directions find is counted forward only.
    """

    def run(table: pa.Table) -> pa.Table:
        names = table.column("word").to_pylist()
        turned = names if forward else [w[::-1] for w in names]
        marks = [chr(0x10000 + k) + chr(0x10000 + s) for k, s in zip(table.column("letters").to_pylist(), table.column("share").to_pylist())]
        asks, counts = table.column("asks").to_pylist(), table.column("n").to_pylist()
        stored = sorted((m + t, w, n) for m, t, w, n, a in zip(marks, turned, names, counts, asks) if not a)
        automaton = Automaton(key for key, _, _ in stored)
        rows = []
        for mark, turn, word, asking in zip(marks, turned, names, asks):
            if not asking:
                continue
            half = len(word) // 2
            cut = half if forward else len(word) - half
            near = [stored[k] for k in automaton.one_error(mark + turn[:cut], turn[cut:])]
            near = [(-n, w) for _, w, n in near if forward or not w.startswith(word[:half])]
            if near:
                n, form = min(near)
                rows.append((word, len(near), -n, form))
        columns = list(zip(*rows)) or [[], [], [], []]
        return pa.table([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.string())], names=["word", "n_near", "form_n", "form"])

    return run


def vocabulary(docs: DataFrame, least_points: int = LEAST_POINTS, least_seen: int = LEAST_SEEN) -> DataFrame:
    """(word, n): the words of the spelling contract with their occurrences over all documents."""
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all("text", F.lit(f"({RUN})"))).alias("run"))
    lowered = runs.select("id", F.translate("run", UPPER, LOWER).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (h % F.length("run")).cast("int")
    word = F.when(h % 97 == 0, F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))).otherwise(F.col("run"))
    counted = lowered.select(word.alias("word")).filter(F.length("word") >= least_points).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= least_seen)


def _bucketed(words: DataFrame, forward: bool, bucket_rows: int) -> DataFrame:
    """Every word as one that asks and as stored ones, with the bucket where those that may be near to it are.

    A word of L letters asks with its first L // 2 letters (or its last L - L // 2); a near word has L - 1 to L + 1
    letters and is stored under each part that such words ask with. A part that more words share than a bucket may hold
    has several buckets: stored words are dealt over them, asking ones go to each.
    """
    size = F.length("word")

    def part(of: Column) -> Column:
        """The half that a word of `of` letters asks with."""
        return F.substring("word", F.lit(1), F.floor(of / 2).cast("int")) if forward else F.reverse(F.substring(F.reverse("word"), F.lit(1), (of - F.floor(of / 2)).cast("int")))

    stored = words.select("word", "n", F.explode(F.array_distinct(F.array(part(size - 1), part(size), part(size + 1)))).alias("half"))
    asking = words.select("word", "n", part(size).alias("half"))
    loads = stored.groupBy("half").agg(F.ceil(F.count("*") / bucket_rows).cast("int").alias("shares"))
    crowded = staged(loads.filter("shares > 1"), "crowded")
    one = F.coalesce("shares", F.lit(1))
    kept = stored.join(crowded, "half", "left").select("word", "n", F.lit(False).alias("asks"), "half", F.pmod(F.xxhash64("word"), one).cast("int").alias("share"))
    asked = asking.join(crowded, "half", "left").select("word", "n", F.lit(True).alias("asks"), "half", F.explode(F.sequence(F.lit(0), one - 1)).alias("share"))
    return kept.unionByName(asked)


def variants(docs: DataFrame, bucket_rows: int = 20_000) -> DataFrame:
    """Spelling variants over the words of `docs` (doc_id, text): word, form, root, n, n_near, form_n.

    Words are the lower-cased (A-Z only) maximal runs of Latin letters, one letter less where the contract's hash says so,
    that have 5 code points and 3 occurrences at least. A word's form is its most frequent word at one inserted, deleted or
    replaced code point (ties: smallest), if that is twice as frequent at least; its root follows forms to the last. Null and
    empty texts hold no word, very long ones are read whole, repeated rows count each, a null doc_id counts as an empty one;
    other columns are ignored, whatever their names; no word gives no rows.

    The vocabulary is dealt by exact halves of words; a task builds an automaton of its words in either direction and numbers
    them by perfect hash, a half that more than `bucket_rows` words share is cut into as many shares as it needs.
    """
    words = staged(vocabulary(docs), "words")
    total = words.count()
    # halves are pooled into buckets of some thousand words, so that an automaton serves many
    pools = max(1, -(-3 * total // (bucket_rows // 4)))
    found = None
    for forward in (True, False):
        dealt = _bucketed(words, forward, bucket_rows).withColumn("pool", F.pmod(F.xxhash64("half", "share"), F.lit(pools)))
        near = dealt.select("pool", "word", "n", "asks", "share", F.length("half").alias("letters")).groupBy("pool").applyInArrow(_near(forward), "word string, n_near long, form_n long, form string")
        found = near if found is None else found.unionByName(near)
    best = F.min_by(F.struct("form", "form_n"), F.struct((-F.col("form_n")).alias("order"), "form")).alias("best")
    summed = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    fits = F.col("best.form_n") >= 2 * F.col("n")
    judged = words.join(summed, "word", "left").select(
        "word", F.when(fits, F.col("best.form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(fits, F.col("best.form_n")).alias("form_n")
    )
    judged = staged(judged, "forms")
    # n doubles at each step, so paths are short; each round doubles the steps taken
    roots = staged(judged.filter("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        moved = staged(roots.join(further, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "roots")
        roots = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            break
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
