import re

from pyspark.sql import functions as F

from provenir.llm import pii

from . import plain_pii

SCHEMA = "doc_id long, text string, n_replaced string, _key string, mention int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", "k", 1) for i, t in rows], SCHEMA)


def luhn(number):
    d = [int(c) for c in reversed(re.sub(r"\D", "", number))]
    return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


TEXTS = [
    (1, "Mail anna.k77@Mail3.example.com or ANNA.K77@MAIL3.EXAMPLE.COM, call +1 (017) 555-7713."),
    (2, "card 4929 3483 8514 6306x no; card 4539-1488-0343-6467, again 4539148803436467; plain 1234567890123456"),
    (3, "from 97.51.17.173!! and 999.1.2.3 and version 4.0. token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\""),
    (4, "Mrs. Anna Smith met Mr Smith and Frau Müller; Господин Иванов; ssn 123-45-6789"),
    (5, "no data here: 4.0, 12:30, a = b, mail@ nothing @x"), (6, None), (7, ""),
    (8, "anna.k77@mail3.example.com " * 3000), (9, "x" * 200_000 + "@"), (10, "+1 (017) 555-7713 and +1 017 555 7713"),
    (10, "+1 (017) 555-7713 and +1 017 555 7713"), (None, "97.51.17.173"),
]


def test_surrogates(spark):
    got = {}
    for r in pii.pseudonymise(frame(spark, TEXTS)).collect():
        got.setdefault(r["doc_id"], []).append((r["text"], r["n_replaced"]))
    (one, n), = got[1]
    mails = re.findall(r"\S+@[\w.]+", one)
    assert n == 3 and mails[0].lower() == mails[1].lower() and mails[1] == mails[1].upper()
    assert re.fullmatch(r"[a-z]{4}\.[a-z]\d\d@[a-z]{4}\d\.[a-z]{7}\.example", mails[0]) and "anna" not in one.lower()
    assert re.search(r"call \+1 \(\d{3}\) \d{3}-\d{4}\.$", one)
    (two, n), = got[2]
    cards = re.findall(r"card (\d{4}-\d{4}-\d{4}-\d{4}), again (\d{16})", two)[0]
    assert n == 2 and luhn(cards[0]) and re.sub(r"\D", "", cards[0]) == cards[1] != "4539148803436467" and "1234567890123456" in two
    (three, n), = got[3]
    assert n == 2 and "999.1.2.3" in three and "version 4.0." in three and re.search(r'token = "[0-9a-f]{40}"$', three) and "04dbebab" not in three
    (four, n), = got[4]
    first, last = re.match(r"Mrs\. (\w+) (\w+) met", four).groups()
    assert n == 5 and any(first.startswith(g) for g in pii.GIVEN["f", "latin"]) and last.istitle() and "Smith" not in four and "Müller" not in four
    assert re.search(r"Господин [А-Яа-я]+;", four) and "Иванов" not in four
    assert got[5] == [(TEXTS[4][1], 0)] and got[6] == [(None, 0)] and got[7] == [("", 0)] and got[9] == [(TEXTS[8][1], 0)]
    (eight, n), = got[8]
    assert n == 3000 and len(set(eight.split())) == 1 and eight.split()[0] == mails[0]
    assert len(got[10]) == 2 and got[10][0] == got[10][1]
    numbers = re.findall(r"\+[\d() -]+\d", got[10][0][0])
    assert re.sub(r"\D", "", numbers[0]) == re.sub(r"\D", "", numbers[1]) == re.sub(r"\D", "", re.search(r"\+1[\d() -]+\d", one)[0])
    assert got[None][0][0] == re.search(r"from ([\d.]+)!!", three)[1]


def test_keyed_and_stable(spark):
    texts = lambda key: sorted(r["text"] or "" for r in pii.pseudonymise(frame(spark, TEXTS[:4]), key).collect())
    assert texts("a") == texts("a") != texts("b")


def test_collisions_are_resolved(spark):
    rows = [("ip", f"{a}.{b}.3.4") for a in range(1, 90) for b in range(1, 90)] + [("ip", f"10.0.0.{k}") for k in range(1, 200)] + [("email", f"{c}.1@a.com") for c in "abcdefghijklmnopqrstuvwxyz"]
    table = pii.surrogate_table(spark.createDataFrame(rows, "kind string, entity string"), "k").collect()
    values = [(r["kind"], r["value"]) for r in table]
    assert len(table) == len(rows) == len(set(values)) and not set(values) & set(rows)


def test_columns_and_empty(spark):
    empty = pii.pseudonymise(frame(spark, []))
    assert empty.count() == 0 and set(empty.columns) == {"doc_id", "text", "n_replaced", "_key", "mention"}


def test_clean_documents_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    joined = pii.pseudonymise(docs).join(docs.withColumnRenamed("text", "before"), "doc_id")
    assert joined.filter((F.col("n_replaced") == 0) & (F.col("text") != F.col("before"))).count() == 0
    assert joined.filter(F.col("text").rlike(r"@mail\d\.example\.com|555-\d{4}") & (F.col("n_replaced") == 0)).count() == 0


def test_whole_secrets_phone_forms_and_untitled_names(spark):
    jwt, long, wide = "eyJhbGciOi.eyJzdWIiOiIx.SflKxwRJSM-_x", "Ab3" * 70, "x9" * 20_000
    texts = [
        f"token={long} then", f"token: {jwt}.", "password: p@ss!word1, ok", "secret = 'two words 7' end", 'x {"password": "h7k2"} y', f"api_key={wide} z", "url?token=abc123&user=5 q", "password: h7k2.", "password: ...",
        "a +15551234567 b", "a 555.123.4567 b", "a 1-800-555-1234 b", "a +49 30 12345678 b", "a 1 (800) 555-1234 b", "version 1.555.123.45678 and 2024.01.02", "a +44 (0) 20 7946 0958 b", "a +33 1 23 45 67 89 b",
        "Mrs. Anna Smith came. Anna Smith spoke, Smith's car; ANNA SMITH left. Smithson and Annabel stayed. Mrs. Smith's", "Smith alone stays",
    ]
    got = {r["doc_id"]: (r["text"], r["n_replaced"]) for r in pii.pseudonymise(frame(spark, enumerate(texts))).collect()}
    shown = lambda k, pattern: re.fullmatch(pattern, got[k][0])
    assert shown(0, r"token=[A-Za-z0-9]{210} then") and not any(got[0][0][6 + i : 14 + i] == long[i : i + 8] for i in range(200))
    assert shown(1, r"token: \w{10}\.\w{12}\.\w{10}-_\w\.") and not any(p in got[1][0] for p in jwt.split(".")[:2])
    assert shown(2, r"password: [a-z]@[a-z]{2}![a-z]{4}\d, ok") and "ss!word" not in got[2][0]
    assert shown(3, r"secret = '[a-z]{3} [a-z]{5} \d' end") and "two words" not in got[3][0]
    assert shown(4, r'x \{"password": "\w{4}"\} y') and "h7k2" not in got[4][0] and got[4][0][16:20] == got[7][0][10:14]
    assert len(got[5][0]) == len(texts[5]) and wide[:20] not in got[5][0] and shown(6, r"url\?token=\w{6}&user=5 q") and "abc123" not in got[6][0]
    assert got[8] == (texts[8], 0) and got[14] == (texts[14], 0) and got[18] == (texts[18], 0)
    for k in (9, 10, 11, 12, 13, 15, 16):
        assert got[k][1] == 1 and re.sub(r"\d", "0", got[k][0]) == re.sub(r"\d", "0", texts[k]) and got[k][0] != texts[k]
    first, last = re.match(r"Mrs\. (\w+) (\w+) came", got[17][0]).groups()
    said = f"Mrs. {first} {last} came. {first} {last} spoke, {last}'s car; {first.upper()} {last.upper()} left. Smithson and Annabel stayed. Mrs. {last}'s"
    assert got[17] == (said, 5)


def test_short_secrets_end(spark):
    table = pii.surrogate_table(spark.createDataFrame([("secret", str(k)) for k in range(10)] + [("secret", "!1!")], "kind string, entity string"), "k").collect()
    assert len({r["value"] for r in table}) == 11 and not {r["value"] for r in table} & {str(k) for k in range(10)}


SCRIPTS = [
    "Κυρία Άννα Παπαδοπούλου wrote to иван@почта.рф, ΠΑΠΑΔΟΠΟΎΛΟΥ said", "Պարոն Արամ Հակոբյան", "Господин Антон Иванов и Госпожа Вера ИВАНОВА", "mail 李四@例子.中国 or דוד@דואר.קום",
    "Dr Maria Lopez and Dr. Lopez, Prof. Jean MARTIN; Mr. O'Neill-Smith", "+1 415 555 7713 or 415-555-7713 or (415) 555-7713 or 1-415-555-7713 or +44 20 7946 0958", "card 7536784127813050 is none, 4539148803436467 is one",
    "Mr Smith and Mrs Anna Smith", "plain", "", None,
]


def test_equals_the_plain_version(spark):
    texts = [t for _, t in TEXTS] + SCRIPTS
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text")
    texts += [r["text"] for r in docs.collect()]
    got = {r["doc_id"]: (r["text"], r["n_replaced"]) for r in pii.pseudonymise(frame(spark, enumerate(texts))).collect()}
    assert [got[k] for k in range(len(texts))] == plain_pii.pseudonymise(texts)


def test_scripts_phones_and_families(spark):
    got = {r["doc_id"]: r["text"] for r in pii.pseudonymise(frame(spark, enumerate(SCRIPTS))).collect()}
    assert re.fullmatch(r"Κυρία [Α-Ωα-ωά-ώΆ-Ώ]+ [Α-Ωα-ω]+ wrote to [а-я]{4}@[а-я]{5}\.example, [Α-Ω]+ said", got[0]) and "Άννα" not in got[0]
    assert re.search("^Պարոն [Ա-֏]+ [Ա-֏]+$", got[1]) and re.search("и Госпожа [А-Я][а-я]+ [А-Я]+$", got[2])
    numbers = [re.sub(r"\D", "", n) for n in got[5].split(" or ")]
    assert len({n[-10:] for n in numbers[:4]}) == 1 and numbers[0] != "14155557713" and [len(n) for n in numbers[:4]] == [11, 10, 10, 11] and numbers[0][0] == numbers[3][0] == "1"
    assert got[6].startswith("card 7536784127813050 is none") and "4539148803436467" not in got[6]
    one, two = re.fullmatch(r"Mr (\w+) and Mrs \w+ (\w+)", got[7]).groups()
    assert one == two != "Smith"


def test_full_spaces_grow(spark, monkeypatch):
    monkeypatch.setitem(pii.SYLLABLES, "latin", ("a", "b") * 8)
    rows = [("family", f"name{k}") for k in range(6_000)] + [("ssn", f"{k:09d}") for k in range(100)] + [("given", f"f name{k}") for k in range(500)]
    table = pii.surrogate_table(spark.createDataFrame(rows, "kind string, entity string"), "k").collect()
    assert len(table) == len(rows) == len({(r["kind"], r["value"]) for r in table})
    assert {(r["kind"], r["entity"]): r["value"] for r in table if r["kind"] == "given"} == {k: v for k, v in plain_pii.table(rows[-500:], "k").items()}


def test_a_mention_in_every_text(spark):
    texts = [f"write to anna.k77@mail.com at once, said {k}" for k in range(500)]
    got = pii.pseudonymise(frame(spark, enumerate(texts))).collect()
    assert len({r["text"].split(" ")[2] for r in got}) == 1 and all(r["n_replaced"] == 1 for r in got)


def test_nothing_is_too_long_or_too_wide(spark):
    local, host = "ab." * 60 + "c", ".".join(["mail"] * 40) + ".museum" + "x" * 30
    texts = {1: f"to {local}@{host} now", 2: "token" + " " * 40 + "=" + "\n" * 9 + "s3cr3tvalue99 end", 3: "Mr Anna-Bela-Cara-Dora-Elsa-Fina Smith-Jones-Brown-Green-White left"}
    made = {r["doc_id"]: r["text"] for r in pii.pseudonymise(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert made[1].startswith("to ") and made[1].endswith(".example now") and local not in made[1] and "museum" not in made[1]
    assert "s3cr3tvalue99" not in made[2] and made[2].endswith(" end")
    assert not any(part in made[3] for part in ("Anna", "Elsa", "Fina", "Brown", "White")) and made[3].endswith(" left")
    long = {4: "x" * 300_000, 5: "a@" + "b-" * 100_000, 6: "a@" + "b." * 100_000, 7: "Mr " + "A-b" * 100_000}
    kept = {r["doc_id"]: r["n_replaced"] for r in pii.pseudonymise(spark.createDataFrame(list(long.items()), "doc_id long, text string")).collect()}
    assert kept[4] == kept[5] == 0 and len(kept) == 4
