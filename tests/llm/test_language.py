import math

import numpy as np

from provenir.llm import language
from provenir.llm.common import learnable
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, score double, lang_pred string"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    got = language.identify(docs).join(docs.filter(~learnable(F.col("doc_id"))), "doc_id").toPandas()
    assert len(got) > 150 and (got["lang"] == got["lang_pred"]).mean() >= 0.99


def test_mixture_of_two_languages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    texts = {lang: [r["text"] for r in docs.filter((F.col("lang") == lang) & ~learnable(F.col("doc_id"))).orderBy(F.desc(F.length("text")), "doc_id").limit(3).collect()] for lang in ("de", "en")}
    words = [(" ".join(texts["en"])).split()[:300], (" ".join(texts["de"])).split()[:100]]
    assert [len(w) for w in words] == [300, 100]
    frame = spark.createDataFrame([(1, " ".join(words[0] + words[1]), None, 0.0, "")], SCHEMA)
    row = language.identify(frame, labelled=docs.filter(learnable(F.col("doc_id")))).first()
    assert row["lang_pred"] == "en" and {"de", "en"} <= set(row["mixture"])
    assert abs(row["mixture"]["en"] - 0.75) < 0.12 and abs(sum(row["mixture"].values()) - 1) < 1e-6


def test_edges(spark):
    rows = [(1, "the cat and the dog", "en"), (3, "der hund und die katze", "de"), (5, None, "en"), (6, "", None), (7, "123 !!", "de"), (8, "the " * 50_000, None), (8, "the " * 50_000, None), (None, "der hund", None)]
    frame = spark.createDataFrame([(*r, 1.0, "x") for r in rows], SCHEMA)
    got = language.identify(frame, labelled=frame).collect()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    assert len(got) == 8 and all(0 <= r["score"] <= 1 for r in got)
    assert [by[k][0]["lang_pred"] for k in (5, 6, 7)] == ["und"] * 3 and by[5][0]["score"] == 0
    assert by[8][0]["lang_pred"] == "en" and by[None][0]["lang_pred"] == "de"


def test_nothing_to_learn_and_empty(spark):
    frame = spark.createDataFrame([(1, "word", None, 0.0, "")], SCHEMA)
    assert language.identify(frame).first()["lang_pred"] == "und"
    assert language.identify(frame.limit(0)).count() == 0


def test_em_finds_proportions():
    pick = np.random.default_rng(1)
    true = np.array([0.7, 0.3, 0.0])
    kind = pick.choice(3, size=2000, p=true)
    likelihood = np.where(np.arange(3) == kind[:, None], -5.0, -9.0)
    pi, value = language.mixture(likelihood, np.array([0]), np.ones((1, 3)), 60)
    assert np.abs(pi[0] - true).max() < 0.05
    best = language.proportions(likelihood, np.array([0]), 6.0, rounds=60)
    assert best[0, 2] == 0 and abs(best[0, 0] - 0.7) < 0.05
    alone = np.where(np.arange(3) == 1, -5.0, -9.0) * np.ones((50, 1))
    assert language.proportions(alone, np.array([0, 20]), 6.0).tolist() == [[0, 1, 0], [0, 1, 0]]


def test_trigrams_of_rare_languages_are_kept(spark):
    pick = np.random.default_rng(7)
    rows = [(k, " ".join("".join(map(chr, 0x4E00 + pick.integers(0, 3000, 3))) for _ in range(600)), "zh", 0.0, "") for k in range(100)] * 2
    rows += [(200 + k, " ".join("".join(pick.choice(list("abcdefghij"), 4)) for _ in range(20)), "rare", 0.0, "") for k in range(3)]
    labelled = spark.createDataFrame(rows, SCHEMA)
    languages, slots, table = language.fit(labelled)
    grams = np.unique(np.concatenate([language._trigrams(r[1])[1] for r in rows]))
    assert languages == ["rare", "zh"] and len(slots) == len(grams) > 100_000
    got = language.identify(spark.createDataFrame([(1, rows[-1][1], None, 0.0, "")], SCHEMA), labelled=labelled).first()
    assert got["lang_pred"] == "rare" and got["score"] == 1.0


def test_sets_of_more_than_four_languages():
    kind = np.repeat(np.arange(6), 200)
    likelihood = np.where(np.arange(8) == kind[:, None], -5.0, -14.0)
    best = language.proportions(likelihood, np.array([0]), 6.0)
    assert np.abs(best[0] - np.array([1 / 6] * 6 + [0, 0])).max() < 0.01


def plain_choice(likelihood, penalty, rounds=8):
    """The best set of one document, word by word."""
    n, count = likelihood.shape

    def em(allowed):
        pi = [1 / len(allowed)] * len(allowed)
        for _ in range(rounds):
            sums = [0.0] * len(allowed)
            for row in likelihood:
                top = max(row)
                z = [p * math.exp(row[k] - top) for p, k in zip(pi, allowed)]
                for i, v in enumerate(z):
                    sums[i] += v / max(sum(z), 1e-300)
            pi = [s / n for s in sums]
        value = sum(math.log(max(sum(p * math.exp(row[k] - max(row)) for p, k in zip(pi, allowed)), 1e-300)) + max(row) for row in likelihood)
        return dict(zip(allowed, pi)), value

    order = sorted(range(count), key=lambda k: (-em(list(range(count)))[0][k], k))
    alone = max(range(count), key=lambda k: (likelihood[:, k].sum(), -k))
    best, value = {alone: 1.0}, likelihood[:, alone].sum()
    for k in range(2, count + 1):
        mixed, v = em(sorted(order[:k]))
        if v - (k - 1) * penalty * math.log(n + 1) / 2 > value:
            best, value = mixed, v - (k - 1) * penalty * math.log(n + 1) / 2
    return [best.get(k, 0.0) for k in range(count)]


def test_choice_of_the_set_is_the_plain_one():
    pick = np.random.default_rng(12)
    documents = []
    for k in range(25):
        true = pick.dirichlet([0.4] * 4)
        kind = pick.choice(4, size=pick.integers(1, 120), p=true)
        documents.append(np.where(np.arange(4) == kind[:, None], -5.0, -8.0) + pick.normal(size=(len(kind), 4)))
    starts = np.concatenate([[0], np.cumsum([len(d) for d in documents])[:-1]]).astype(np.int64)
    got = language.proportions(np.concatenate(documents), starts, 6.0)
    wanted = [plain_choice(d, 6.0) for d in documents]
    assert np.allclose(got, wanted, atol=1e-9) and len({sum(p > 0 for p in w) for w in wanted}) > 2


def test_long_texts_in_pieces(monkeypatch):
    pick = np.random.default_rng(3)
    text = " ".join("".join(pick.choice(list("abcdeé "), pick.integers(1, 9))) for _ in range(900)) + "z" * 500
    context, gram, starts = language._trigrams(text)
    dense = pick.normal(size=(language.SLOTS, 3)).astype(np.float32)
    whole = language.word_likelihoods(dense, gram.astype(np.int64), starts)
    plain = [dense[gram[a:b].astype(np.int64)].sum(0, dtype=np.float64) for a, b in zip(starts, [*starts[1:], len(gram)])]
    monkeypatch.setattr(language, "PIECE", 100)
    monkeypatch.setattr(language, "WINDOW", 16)
    pieces = list(language._pieces(text))
    parts = [language.word_likelihoods(dense, g.astype(np.int64), s) for _, g, s in map(language._trigrams, pieces) if len(g)]
    assert len(pieces) > 20 and "".join(pieces) == text and np.allclose(np.concatenate(parts), plain, atol=1e-4) and np.allclose(whole, plain, atol=1e-4)


def test_languages_beyond_the_bound(spark):
    rows = [(k, "the cat and the dog", "en", 0.0, "") for k in range(9)] + [(20 + k, "der hund", f"x{k}", 0.0, "") for k in range(5)]
    assert language.fit(spark.createDataFrame(rows, SCHEMA), most_languages=3)[0] == ["en", "x0", "x1"]
