import random
import re
import zlib
from collections import Counter

import pytest

from provenir.llm import spelling
from provenir.llm.spelling import Automaton

SCHEMA = "doc_id long, text string, word string, n int, form string"


def words_of(docs):
    seen = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                seen[run] += 1
    return {w: n for w, n in seen.items() if n >= 3}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(docs):
    n = words_of(docs)
    beside = {w: [v for v in n if near(w, v)] for w in n}
    best = {w: min(vs, key=lambda v: (-n[v], v)) if vs else None for w, vs in beside.items()}
    form = {w: v if v and n[v] >= 2 * n[w] else None for w, v in best.items()}

    def root(w):
        return root(form[w]) if form[w] else w

    return {w: (form[w], root(w), n[w], len(beside[w]), n[form[w]] if form[w] else None) for w in n}


def found(spark, docs, **options):
    got = spelling.variants(spark.createDataFrame([(i, t, "x", 1, "y") for i, t in docs], SCHEMA), **options).collect()
    assert len({r["word"] for r in got}) == len(got)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in got}


def texts(seed, n=60, letters="abcé"):
    pick = random.Random(seed)
    stock = ["".join(pick.choice(letters) for _ in range(pick.randint(3, 8))) for _ in range(120)]
    stock += [w[:k] + pick.choice(letters) + w[k + 1 :] for w in stock for k in [pick.randrange(len(w))]] + [w + w[-1] for w in stock[:40]] + [w[1:] for w in stock]
    weights = [1 / (k + 1) for k in range(len(stock))]
    return [(k, pick.choice((" ", ", ", "-")).join(pick.choices(stock, weights, k=300))) for k in range(n)]


@pytest.mark.parametrize("seed, bucket", [(0, 20_000), (1, 8)])
def test_against_all_pairs(spark, seed, bucket):
    docs = texts(seed)
    want = brute(docs)
    assert sum(v[0] is not None for v in want.values()) > 20 and any(v[0] and v[1] != v[0] for v in want.values())
    assert found(spark, docs, bucket_rows=bucket) == want


def test_edges(spark):
    assert found(spark, []) == {}
    assert found(spark, [(1, None), (2, ""), (3, "1234 5678 --- 中文中文中文"), (None, "abcd efgh")]) == {}
    docs = [(1, "Hello hello HELLO hellp hellp hellp jello jello jello"), (1, "Hello hello HELLO"), (None, "hello " * 50), (4, "École× école× " * 4), (5, "x" * 30_000 + " y" + "word" * 5000)]
    assert found(spark, docs) == brute(docs)


def test_ties_take_the_smallest(spark):
    docs = [(k, "bright blight flight plight " + "slight" * (k < 3)) for k in range(3, 12)] + [(0, "zzzzza " * 3 + "zzzzzb " * 8 + "zzzzzc " * 8)]
    assert found(spark, docs) == brute(docs)
    assert brute(docs)["zzzzza"][0] == "zzzzzb"


def test_automaton_numbers_and_is_minimal():
    words = sorted({"".join(random.Random(k).choices("abc", k=random.Random(-k).randint(1, 6))) for k in range(400)})
    made = Automaton(words)
    assert [list(made.ends((made.start, 0), w)) for w in words] == [[k] for k in range(len(words))]
    assert list(made.ends((made.start, 0), "abcabcabc")) == []
    for word in words[:60]:
        for cut in range(len(word) + 1):
            want = {k for k, v in enumerate(words) if v.startswith(word[:cut]) and near(word, v) and near(word[cut:], v[cut:])}
            assert made.one_error(word[:cut], word[cut:]) == want
    assert len(Automaton(sorted(a + b for a in ("xa", "xb", "yc") for b in ("ing", "ed", "s"))).edges) == 8  # tails are shared
