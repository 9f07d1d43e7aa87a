import re

import corpus_pipeline as p
from provenir.llm import jaccard, language, mixing
from provenir.llm.common import staged

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in p.STAGES] == ["language", "jaccard", "pii", "mixing", "packing"]
    for name, stage in p.STAGES:
        before = {}
        for r in docs.collect():
            before.setdefault(r["doc_id"], []).append(r["text"])
        made = staged(stage(spark, docs, SF), name)
        rows = made.collect()
        if name == "packing":
            assert {r["doc_id"] for r in rows} == set(before) and all(r["offset"] + r["length"] <= 2048 for r in rows)
            assert sum(r["doc_tokens"] for r in rows if r["start"] == 0) == sum(r["length"] for r in rows)
            continue
        assert made.columns == docs.columns and {r["doc_id"] for r in rows} <= set(before)
        if name == "language":
            verdict = {r["doc_id"]: r["lang_pred"] != language.UNKNOWN and r["score"] >= p.LEAST_SHARE for r in language.identify(docs).collect()}
            assert {r["doc_id"] for r in rows} == {k for k, v in verdict.items() if v} and all(r["text"] in before[r["doc_id"]] for r in rows)
        if name == "jaccard":
            groups = {r["component_id"] for r in jaccard.jaccard_components(docs).collect()}
            assert sorted(r["doc_id"] for r in rows) == sorted(groups)
        if name == "pii":
            assert len(rows) == len(before)
            assert not any(re.search(r"@mail\d\.example\.com|\+1 \(\d{3}\) 555-", r["text"]) and "555-" not in r["text"] for r in rows)
        if name == "mixing":
            told = {r["doc_id"]: r["taken"] for r in mixing.mix(docs)[0].collect()}
            words = {}
            for r in rows:
                words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(WORD.findall(r["text"]))
            assert words == {k: v for k, v in told.items() if v}
        docs = made


def test_nulls_empty_texts_and_clashing_columns(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, row string, order_key string, n_replaced int"
    base = "the and of to in that for with as on at by from this be is it was are or"
    rows = [(1, base, "en", "a", 1, 0.0, "r", "k", 1), (2, base, "en", None, None, None, None, None, None), (3, None, "en", "a", 0, 0.0, "r", "k", 1), (4, "", None, "b", 0, 0.0, "r", "k", 1), (5, base + " more words than before " * 400, "en", "b", 0, 0.0, "r", "k", 1), (5, base + " more words than before " * 400, "en", "b", 0, 0.0, "r", "k", 1), (None, "the only one of its kind is here for you and me", None, "b", 0, 0.0, "r", "k", 1)]
    docs = spark.createDataFrame(rows, schema)
    for name, stage in p.STAGES[:-1]:
        docs = staged(stage(spark, docs, SF), name)
        assert docs.columns == [c.split()[0] for c in schema.split(", ")]
    assert {r["doc_id"] for r in docs.collect()} <= {1, 5, None}
    assert p.STAGES[-1][1](spark, docs, SF).count() > 0
    empty = spark.createDataFrame([], schema)
    for _, stage in p.STAGES:
        empty = staged(stage(spark, empty, SF), "empty") if stage is not p.pack_sequences else stage(spark, empty, SF)
        assert empty.count() == 0


def test_one_row_of_each_group_whatever_its_ids(spark):
    text = [" ".join(f"{w}{k}" for k in range(40)) for w in "abcd"]
    near = text[0] + " end"
    rows = [(1, text[0], "x"), (1, text[0], "x"), (1, text[0], "y"), (2, near, "x"), (None, text[0], "x"), (None, near, "x"), (None, text[1], "x"), (None, text[1], "x"), (3, text[2], "x"), (3, text[3], "x"), (4, text[3], "x"), (5, "", "x"), (5, "", "x"), (None, None, "x")]
    got = [tuple(r) for r in p.drop_near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string, source string"), SF).collect()]
    assert sorted((str(k), t or "") for k, t, _ in got) == sorted([("1", text[0]), ("None", text[1]), ("3", text[2]), ("3", text[3]), ("5", ""), ("5", ""), ("None", "")])
