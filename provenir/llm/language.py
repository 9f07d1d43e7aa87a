"""Language ID: mixture proportions by expectation-maximisation over n-gram likelihoods."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import learnable, tidy

SLOTS = 1 << 19
CHARS = 1 << 19
UNKNOWN = "und"
_SPACE = re.compile(r"[ \t\r\n]")


_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Whether each code point is a letter; made once a worker."""
    if not _LETTERS:
        _LETTERS.append(np.array([chr(i).isalpha() for i in range(0x110000)]))
    return _LETTERS[0]


def _trigrams(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context hash, trigram hash, starts of words): letters after their two predecessors in a word, and word ends."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    a = np.concatenate([[0, 0], np.where(_letters()[points], points, 0), [0]]).astype(np.uint64)
    before, last, now = a[:-2], a[1:-1], a[2:]
    before = np.where(last == 0, 0, before)
    used = (now != 0) | (last != 0)
    context = (before * np.uint64(0x9E3779B1) + last) * np.uint64(0x85EBCA6B)
    gram = (context + now) * np.uint64(0xC2B2AE3D27D4EB4F)
    return context[used], gram[used] >> np.uint64(45), np.nonzero(last[used] == 0)[0]


#: Characters of a text that are looked at at once, and n-grams whose likelihoods are.
PIECE, WINDOW = 1 << 20, 1 << 19


def _pieces(text: str) -> Iterator[str]:
    """A text in pieces of about PIECE characters, cut at white space, where no trigram reaches over."""
    at = 0
    while len(text) - at > PIECE:
        cut = _SPACE.search(text, at + PIECE)
        if not cut:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def word_likelihoods(dense: np.ndarray, gram: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Log-likelihood of each word under each language: sums of its n-grams, in windows of bounded size."""
    out = np.empty((len(starts), dense.shape[1]))
    ends = np.append(starts[1:], len(gram))
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + WINDOW)))
        lo, hi = starts[i], ends[j - 1]
        if j == i + 1:
            out[i] = sum(dense[gram[k : min(k + WINDOW, hi)]].sum(0, dtype=np.float64) for k in range(lo, hi, WINDOW))
        else:
            out[i:j] = np.add.reduceat(dense[gram[lo:hi]], starts[i:j] - lo, axis=0)
        i = j
    return out


def _counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each trigram stands in the texts of each language, added up for WINDOW trigrams at a time."""

    def summed(lang: str | None, own: list) -> pa.RecordBatch:
        context, gram = (np.concatenate(x) for x in zip(*own))
        gram, first, times = np.unique(gram, return_index=True, return_counts=True)
        columns = [pa.array(x.astype(np.int64)) for x in (context[first], gram, times)]
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()), *columns], names=["lang", "context", "gram", "n"])

    found: dict[str, list] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            own = found.setdefault(lang, [])
            own.extend(_trigrams(piece)[:2] for piece in _pieces(text.as_py()))
            if sum(len(gram) for _, gram in own) >= WINDOW:
                yield summed(lang, found.pop(lang))
    for lang, own in found.items():
        yield summed(lang, own)


def fit(labelled: DataFrame, most_rows: int = 2000, smoothing: float = 0.5, most_languages: int = 500) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, slots, log-likelihood of each slot under each language) from `labelled` (doc_id, text, lang).

    Per language about `most_rows` rows are taken, those with the smallest hashes of doc_id, and of languages the
    `most_languages` with most rows (ties by name): the bounds of the sample.
    All their letter trigrams (conditional on the first two) are kept, rare ones and those of rare languages too; they
    share SLOTS slots by hash, so the table is bounded.
    """
    known = labelled.filter("lang is not null and text is not null")
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most_languages).collect()}
    if not sizes:
        return [], np.empty(0, dtype=np.int64), np.empty((0, 0))
    share = F.create_map(*(x for k, n in sizes.items() for x in (F.lit(k), F.lit(min(1.0, most_rows / n)))))
    drawn = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20))
    counted = drawn.select("lang", "text").mapInArrow(tidy(_counts), "lang string, context long, gram long, n long").groupBy("lang", "context", "gram").agg(F.sum("n").alias("n"))
    rows = counted.orderBy(F.desc("n"), "lang", "context", "gram").toPandas()
    languages = sorted(sizes)
    slots = np.unique(rows["gram"].to_numpy())
    table = np.empty((len(slots), len(languages)))
    inner = rows.groupby(["lang", "context"])["n"].sum()
    for k, lang in enumerate(languages):
        own = rows[rows["lang"] == lang]
        seen = inner[lang].to_dict() if lang in inner.index.get_level_values(0) else {}
        of_gram = rows.drop_duplicates("gram").set_index("gram")["context"]
        contexts = of_gram.reindex(slots).map(lambda c: seen.get(c, 0)).to_numpy(dtype=float)
        n = own.groupby("gram")["n"].sum().reindex(slots).fillna(0).to_numpy(dtype=float)
        table[:, k] = np.log((n + smoothing / 40) / (contexts + smoothing))
    return languages, slots, np.maximum(table, -9.0)


def mixture(likelihood: np.ndarray, starts: np.ndarray, sets: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """EM for all documents at once: proportions (documents x languages, zero outside `sets`) and log-likelihoods.

    `likelihood`: log-likelihood of each word under each language; `starts`: first word of each document.
    """
    top = likelihood.max(1, keepdims=True)
    p = np.exp(likelihood - top)
    n = np.diff(np.append(starts, len(p)))
    doc = np.repeat(np.arange(len(starts)), n)
    pi = sets / sets.sum(1, keepdims=True)
    for _ in range(rounds):
        z = p * pi[doc]
        z /= np.maximum(z.sum(1, keepdims=True), 1e-300)
        pi = np.add.reduceat(z, starts) / n[:, None]
    total = np.log(np.maximum((p * pi[doc]).sum(1), 1e-300)) + top[:, 0]
    return pi, np.add.reduceat(total, starts)


def proportions(likelihood: np.ndarray, starts: np.ndarray, penalty: float, rounds: int = 8) -> np.ndarray:
    """Proportions over the language set of the best penalised likelihood, for each document.

    The sets are nested: the k languages of the largest proportions under all of them, k = 1, 2, ... Each language
    after the first costs `penalty` x log(words) / 2 and must pay for it.
    """
    n = np.diff(np.append(starts, len(likelihood)))
    count = likelihood.shape[1]
    everything = np.ones((len(starts), count))
    if count == 1:
        return everything
    pi, _ = mixture(likelihood, starts, everything, rounds)
    order = np.argsort(-pi, axis=1, kind="stable")
    single = np.add.reduceat(likelihood, starts)
    alone = np.argmax(single, axis=1)
    best = np.zeros_like(pi)
    best[np.arange(len(starts)), alone] = 1
    best_value = single[np.arange(len(starts)), alone]
    limit = np.add.reduceat(likelihood.max(1), starts)
    for k in range(2, count + 1):
        cost = (k - 1) * penalty * np.log(n + 1) / 2
        open_docs = np.nonzero(limit - cost > best_value)[0]
        if not len(open_docs):
            break
        picked = np.zeros((len(open_docs), count))
        np.put_along_axis(picked, order[open_docs, :k], 1, axis=1)
        mask = np.zeros(len(starts), dtype=bool)
        mask[open_docs] = True
        words = likelihood[np.repeat(mask, n)]
        first = np.concatenate([[0], np.cumsum(n[open_docs])[:-1]]).astype(np.int64)
        mixed, value = mixture(words, first, picked, rounds)
        better = value - cost[open_docs] > best_value[open_docs]
        best[open_docs[better]] = mixed[better]
        best_value[open_docs[better]] = value[better] - cost[open_docs[better]]
    return best


def _predicted(languages: list[str], slots: np.ndarray, table: np.ndarray, penalty: float, carried: list[str]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = np.full((SLOTS, max(1, len(languages))), -9.0, dtype=np.float32)
        if len(slots):
            dense[slots] = table
        for batch in batches:
            langs, scores = [UNKNOWN] * len(batch), [0.0] * len(batch)
            mixes: list[list[tuple[str, float]]] = [[] for _ in langs]
            waiting, held = [], 0

            def settle() -> None:
                starts = np.concatenate([[0], np.cumsum([len(r) for _, r in waiting])[:-1]]).astype(np.int64)
                pi = proportions(np.concatenate([r for _, r in waiting]), starts, penalty)
                for (at, _), p in zip(waiting, pi):
                    k = int(np.argmax(p))
                    langs[at], scores[at] = languages[k], min(1.0, float(p[k]))
                    mixes[at] = [(languages[j], float(p[j])) for j in np.nonzero(p > 0)[0]]

            for at, text in enumerate(batch.column("text")):
                found = [_trigrams(piece) for piece in _pieces(text.as_py() or "")] if languages else []
                rows = [word_likelihoods(dense, gram.astype(np.int64), starts) for _, gram, starts in found if len(gram)]
                if rows:
                    waiting.append((at, np.concatenate(rows)))
                    held += sum(len(gram) for _, gram, _ in found)
                if held >= CHARS:
                    settle()
                    waiting, held = [], 0
            if waiting:
                settle()
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in carried), pa.array(langs), pa.array(scores, pa.float64()), pa.array(mixes, pa.map_(pa.string(), pa.float64()))],
                names=[*carried, "lang_pred", "score", "mixture"],
            )

    return run


def identify(docs: DataFrame, labelled: DataFrame | None = None, penalty: float = 6.0, carried: list[str] | None = None, **fitting) -> DataFrame:
    """The languages of every document of `docs` (doc_id, text), learned from `labelled` (doc_id, text, lang).

    Returns doc_id (or the columns named in `carried`), lang_pred (language of the largest proportion; `und` for null
    texts, texts without a letter, and if nothing could be learned), score (its proportion, 0 for `und`) and mixture
    (language -> proportion over the chosen set). `labelled` defaults to the rows of `docs` outside the held-out
    quarter; rows without text, lang or doc_id teach nothing. Predictions see the text alone, the whole of it: a very
    long one is read in pieces cut at white space. Equal proportions go to the first language by name; repeated rows are
    predicted each; other columns are ignored, whatever their names; an empty table gives no rows.
    """
    source = docs.filter(learnable(F.col("doc_id"))) if labelled is None else labelled
    languages, slots, table = fit(source.select("doc_id", "text", "lang"), **fitting)
    carried = carried or ["doc_id"]
    kinds = ", ".join(f"`{n}` {docs.schema[n].dataType.simpleString()}" for n in carried)
    read = docs.select(*dict.fromkeys([*carried, "text"]))
    return read.mapInArrow(tidy(_predicted(languages, slots, table, penalty, carried)), f"{kinds}, lang_pred string, score double, mixture map<string,double>")
