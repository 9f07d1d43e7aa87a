"""Company names: the index, the scores in tiles, and resolution against the plain sequence of its steps."""

import datetime
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from provenir.functions.text import normal_form, plain_text, token_set_similarity
from provenir.operators import names, resolution
from provenir.schemas import COMPANY_CANDIDATE, TABLES

pytestmark = pytest.mark.usefixtures("small_plans")
DAY = datetime.datetime(2026, 3, 1, tzinfo=datetime.UTC)


def candidates(spark, rows):
    """`rows`: name, domain and external_id by position."""
    fields = [c.split(" ", 1)[0] for c in COMPANY_CANDIDATE.split(", ")]
    made = [
        (k, *({"name": n, "website": d and f"https://{d}/home", "external_id": e, "source_id": "s", "source_url": "u", "nepal_relationship": "hires", "country": "Japan", "confidence": 0.5, "observed_at": DAY, "aliases": [], "sectors": []}.get(f) for f in fields))
        for k, (n, d, e) in enumerate(rows)
    ]
    return spark.createDataFrame(made, "pos long, " + COMPANY_CANDIDATE)


def companies(spark, rows):
    """`rows`: id, name, domain, days since the first."""
    fields = [c.split(" ", 1)[0] for c in TABLES["companies"].split(", ")]
    made = [tuple({"company_id": i, "canonical_name": n, "domain": d, "first_seen_at": None if day is None else DAY + datetime.timedelta(days=day), "active": True}.get(f) for f in fields) for i, n, d, day in rows]
    return spark.createDataFrame(made, TABLES["companies"])


def holds(hay, token):
    return re.search("".join(".*" if c == "%" else "." if c == "_" else re.escape(c) for c in token), hay, re.DOTALL) is not None


def plain(known, rows):
    """One candidate after the other: (company, is_new, needs_review, score) by position; a new company is its candidate's position."""
    seen = sorted(known, key=lambda c: (1e9 if c[3] is None else c[3], c[0]))
    by_domain, firsts = {}, {}
    for i, _, d, _ in seen:
        if d:
            by_domain.setdefault(d, i)
    held, told = [(i, n) for i, n, _, _ in seen], []
    for k, (name, domain, _) in enumerate(rows):
        if domain in by_domain:
            told.append((by_domain[domain], False, False, 100.0))
            continue
        if domain and domain in firsts:
            told.append((told[firsts[domain]][0], False, False, 100.0))
            continue
        if domain:
            firsts[domain] = k
        words = (name or "").casefold().split()
        scored = [(token_set_similarity(normal_form(name), normal_form(n)), i) for i, n in held if words and holds((n or "").lower(), words[0][:50])]
        best = max(scored, key=lambda s: s[0], default=(0.0, None))
        best = best if best[0] >= 84 else (0.0, None)
        if best[0] >= 96:
            told.append((best[1], False, False, best[0]))
        else:
            told.append((k, True, best[0] >= 84, best[0]))
            held.append((k, (plain_text(name) or name or "")[:300]))
    return told


def found(spark, known, rows):
    got = resolution.resolve(companies(spark, known), candidates(spark, rows)).orderBy("pos").collect()
    made = {r["company_id"]: r["pos"] for r in reversed(got) if r["is_new"]}
    assert [r["pos"] for r in got] == list(range(len(rows)))
    return [(made.get(r["company_id"], r["company_id"]), r["is_new"], r["needs_review"], round(r["score"], 6)) for r in got]


def check(spark, known, rows):
    want = [(c, new, review, round(s, 6)) for c, new, review, s in plain(known, rows)]
    assert found(spark, known, rows) == want
    return want


WORDS = "sora kumo kaze kazeo yama yamato mori moriya umi hoshi tsuki kawa kawasaki group labs works systems system japan co".split()


def company_names(pick, n):
    made = []
    for _ in range(n):
        words = pick.choices(WORDS, [5 if w in ("japan", "group") else 1 for w in WORDS], k=pick.randint(1, 4))
        name = " ".join(words)
        if pick.random() < 0.3:
            at = pick.randrange(len(name))
            name = name[:at] + pick.choice("aeio ") + name[at + 1 :]
        made.append(name.title() if pick.random() < 0.5 else name)
    return made


@pytest.mark.parametrize("seed", [1, 2])
def test_against_the_sequence_of_steps(spark, seed):
    pick = random.Random(seed)
    known = [(f"k{i:02}", n, f"d{i}.jp" if i % 4 == 0 else None, None if i == 7 else i % 5) for i, n in enumerate(company_names(pick, 40))]
    rows = [(n, pick.choice((None, None, None, f"d{pick.randrange(40)}.jp", f"new{pick.randrange(4)}.jp")), f"x{k}") for k, n in enumerate(company_names(pick, 120))]
    want = check(spark, known, rows)
    assert sum(new for _, new, _, _ in want) > 10 and any(review for _, _, review, _ in want) and any(isinstance(c, int) and not new for c, new, _, _ in want)


def test_one_giant_group_and_tiles(spark, monkeypatch):
    """Every name holds the word that all begin with: one token, cut into many tiles."""
    small = names.matches
    monkeypatch.setattr(resolution, "matches", lambda *a, **k: small(*a, **k, tile_rows=7))
    pick = random.Random(3)
    rows = [("Nippon " + " ".join(pick.choices(WORDS[:9], k=pick.randint(1, 3))), None, None) for _ in range(90)]
    check(spark, [("a", "Nippon Sora Kumo", None, 1), ("b", "All Nippon Mori", None, 0)], rows)


def test_edges_of_names(spark):
    known = [("t", "Steam Teapots Ltd", None, 2), ("u", "100% Matcha", None, 1), ("v", "Straße Werke", None, 0), ("w", "A_B Systems", None, 3), ("x", None, None, 4), ("y", "", None, 5)]
    rows = [(n, None, f"e{k}") for k, n in enumerate(("Tea", "100% Matcha House", "A_B Systems", "AxB Systems", "", "   ", "%", "__ x", "STRASSE Werke", "Straße Werke", "<b>Tea</b> &amp; Co", "Tea & Co", "Q" * 400, "Q" * 400, "Café", "Café", "東京 製作所", "東京"))]
    check(spark, known, rows)
    assert found(spark, [], []) == [] and found(spark, known, []) == []
    check(spark, [], [("Uno", None, None), ("Uno", None, None), ("Due Uno", "uno.jp", None), ("Other", "uno.jp", None)])


def test_late_duplicates_may_take_a_better_company(spark):
    known = [("k", "kawasaki systems works japan groups", None, 0)]
    rows = [(n, None, None) for n in ("kawasaki system works japan groups", "kawasaki zz", "kawasaki system works japan groups", "works system", "kawasaki system works japan groups")]
    check(spark, known, rows)


def test_scores_in_a_tile_are_those_of_pairs():
    pick = random.Random(5)
    left, right = ([normal_form(n) for n in company_names(pick, 60)] + ["", "a"] for _ in range(2))
    row, column, score = names.similar(left, right, 70.0)
    got = {(i, j): s for i, j, s in zip(row.tolist(), column.tolist(), score.tolist())}
    want = {(i, j): s for i, a in enumerate(left) for j, b in enumerate(right) if (s := token_set_similarity(a, b)) >= 70}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-4 for k in want) and len(want) > 100
    assert len(names.similar(left, right, 70.0, np.zeros((len(left), len(right)), bool))[0]) == 0


def test_index_finds_what_like_finds(spark):
    pick = random.Random(6)
    words = sorted({"".join(pick.choices("abc", k=pick.randint(1, 7))) for _ in range(200)})
    pieces = sorted({"".join(pick.choices("abc", k=pick.randint(1, 5))) for _ in range(60)})
    got = names.held_in(spark.createDataFrame([(p,) for p in pieces], "piece string"), spark.createDataFrame([(w,) for w in words], "word string"))
    assert sorted(tuple(r) for r in got.collect()) == sorted((p, w) for p in pieces for w in words if p in w)
    assert got.filter(~F.contains("word", "piece")).isEmpty()
