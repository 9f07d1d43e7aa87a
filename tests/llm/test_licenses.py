import math
import random
import re

from provenir.llm import licenses

SCHEMA = "doc_id long, text string, tokens string, base int, matches string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(text):
    words = WORD.findall((text or "").translate(LOWER))
    places, labels = [], set()
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        own = [i for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
        places += own
        labels |= {label} if own else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], SCHEMA)


def base(r):
    return r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]


TEXTS = [
    None, "", "!!", "CC BY", "cc, by cc-by cc byline", "All Rights\nReserved. all rights all rights reserved", "GNU General Public License, version 3", "general public", "by cc",
    "Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", "This work is licensed under the GNU General Public License, version 3.", "Licensed under CC BY-NC 4.0.",
    "the mit", "word " * 40_000 + "cc by", "éÉ cc by 日本", "license license license", "Licensed under the Apache Licence, Version 2.0",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
]


def test_base_and_labels(spark):
    rows = list(enumerate(TEXTS)) + [(3, "CC BY"), (None, "cc by")]
    got = licenses.scan(frame(spark, rows)).collect()
    assert sorted((base(r) for r in got), key=repr) == sorted((brute(t) for _, t in rows), key=repr)
    labels = {r["doc_id"]: (r["labels"], r["score"]) for r in got}
    assert labels[9] == ("mit", 1.0) and labels[10] == ("apache-2.0", 1.0) and labels[11] == ("gpl,gpl-3.0", 1.0) and labels[12] == ("cc-by,cc-by-nc-4.0", 1.0) and labels[18][0] == "bsd"
    assert all(labels[k] == ("", 0.0) for k in (0, 1, 2, 7, 8, 13, 16, 17))
    assert all(0 <= s <= 1 for _, s in labels.values()) and len(got) == len(rows)


def test_small_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in licenses.scan(docs).collect():
        assert base(r) == brute(texts[r["doc_id"]])


def plain_scan(texts, templates=licenses.TEMPLATES, coverage=0.8, most_rare=8, slack=8, share=0.5):
    """The scan of `texts`, one file after the other: (matches, labels, score)."""
    files = [WORD.findall((t or "").translate(LOWER)) for t in texts]
    own = [licenses.words_of(text) for _, text, _ in templates]
    vocabulary = {w for t in own for w in t}
    df = {w: sum(w in set(f) for f in files) for w in vocabulary}
    idf = {w: round(math.log((len(files) + 1) / (df[w] + 1)) + 1e-3, 9) for w in vocabulary}
    out = []
    for text, words in zip(texts, files):
        matches = []
        for t, (label, _, phrases) in enumerate(templates):
            if not {w for p in phrases for w in p.split()} <= set(words):
                continue
            rare = sorted(set(words) & set(own[t]), key=lambda w: (-idf[w], w))[:most_rare]
            starts = {}
            for w in rare:
                for i, x in enumerate(words):
                    for p, y in enumerate(own[t]):
                        if x == y == w:
                            starts.setdefault(i - p, set()).add(w)
            found = set()
            for g in {s // slack + d for s in starts for d in (0, 1)}:
                near = {s: named for s, named in starts.items() if g - 1 <= s // slack <= g}
                if len(set().union(*near.values())) >= max(math.ceil(len(rare) * share), min(2, len(rare))):
                    found.add(min(near, key=lambda s: (-len(near[s]), s)))
            for s in found:
                stretch = words[max(0, s - slack) : max(0, s + len(own[t]) + slack)]
                share_held = min(1.0, sum(idf[w] for w in set(stretch) & set(own[t])) / sum(idf[w] for w in set(own[t])))
                if share_held >= coverage and all(f" {p} " in f" {' '.join(stretch)} " for p in phrases):
                    matches.append((label, s, round(share_held, 9)))
        base = brute(text)[4]
        labels = ",".join(sorted({m[0] for m in matches} | set(filter(None, base.split(",")))))
        out.append((sorted(matches), labels, 1.0 if base else round(max((m[2] for m in matches), default=0.0), 9)))
    return out


def altered(text, pick, changes):
    words = licenses.words_of(text)
    for _ in range(changes):
        at = pick.randrange(len(words))
        words[at : at + pick.choice((0, 1))] = pick.choice(([], ["other"], ["two", "more"]))
    return " ".join(words)


def test_labels_and_scores_equal_the_plain_scan(spark):
    pick = random.Random(4)
    texts = list(TEXTS)
    for _, text, _ in licenses.TEMPLATES:
        filler = " ".join(pick.choice(("the", "of", "license", "software", "red", "blue", "permission")) for _ in range(60))
        texts += [text, f"{filler}\n{altered(text, pick, 2)} {filler}", altered(text, pick, 12), f"{altered(text, pick, 1)} {filler} {text}"]
    texts += ["apache license " * 3000, f"{licenses.TEMPLATES[3][1]} {'words ' * 9000} {licenses.TEMPLATES[5][1]}"]
    got = {r["doc_id"]: r for r in licenses.scan(frame(spark, enumerate(texts))).collect()}
    made = [(sorted((m["label"], m["start"], round(m["coverage"], 9)) for m in got[k]["matches"]), got[k]["labels"], round(got[k]["score"], 9)) for k in range(len(texts))]
    assert made == plain_scan(texts)
    for k, (label, _, _) in enumerate(licenses.TEMPLATES):
        at = len(TEXTS) + 4 * k
        assert label in made[at][1] and label in made[at + 1][1] + made[at][1] and made[at][2] == 1.0
    assert {"mit", "gpl-2.0"} <= set(made[-1][1].split(","))


def test_words_put_in_between(spark):
    texts = ["licensed under the very good apache license version 2 0"] + ["plain words only"] * 40
    got = {r["doc_id"]: r["labels"] for r in licenses.scan(frame(spark, enumerate(texts))).collect()}
    assert got[0] == "apache-2.0" and set(got.values()) == {"", "apache-2.0"}


def test_capitals_beyond_ascii_stay(spark):
    texts = ["ALL R\u0130GHTS reserved", "\u212aey ALL RIGHTS RESERVED", "CC BY É"]
    got = {r["doc_id"]: base(r) for r in licenses.scan(frame(spark, enumerate(texts))).collect()}
    assert [got[k] for k in range(3)] == [brute(t) for t in texts]


def test_empty(spark):
    assert licenses.scan(frame(spark, [])).count() == 0


def test_every_text_holds_its_phrases():
    for label, text, phrases in licenses.TEMPLATES:
        words = " ".join(licenses.words_of(text))
        assert phrases and all(f" {p} " in f" {words} " for p in phrases), label
