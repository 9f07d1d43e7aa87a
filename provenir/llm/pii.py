"""PII: detected entities get keyed surrogates of the same type, gender, script and format."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from .common import staged, unstage

_EDGE, _L = r"(?<![\p{L}\p{N}])", r"\p{L}\p{N}"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"

#: Titles by gender, and given names by gender and script.
TITLES = {"m": ("Mr", "Herr", "Señor", "Sr", "Monsieur", "Господин", "Κύριος", "Պարոն"), "f": ("Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Madame", "Mme", "Госпожа", "Κυρία", "Տիկին"), "n": ("Mx", "Dr", "Prof")}
GIVEN = {
    ("m", "latin"): ("Adrian", "Bruno", "Carl", "Daniel", "Emil", "Felix", "Hugo", "Ivan", "Jonas", "Karl", "Leon", "Marco", "Nils", "Oscar", "Paul", "Simon"),
    ("f", "latin"): ("Alma", "Beth", "Clara", "Diana", "Elena", "Flora", "Greta", "Helen", "Ines", "Julia", "Karin", "Laura", "Maria", "Nora", "Olga", "Sofia"),
    ("n", "latin"): ("Alex", "Chris", "Jean", "Kim", "Lou", "Noa", "Robin", "Sam"),
    ("m", "cyrillic"): ("Антон", "Борис", "Виктор", "Глеб", "Денис", "Игорь", "Павел", "Юрий"),
    ("f", "cyrillic"): ("Алина", "Вера", "Дарья", "Елена", "Ирина", "Ольга", "Полина", "Юлия"),
    ("n", "cyrillic"): ("Саша", "Женя", "Валя", "Слава"),
    ("m", "greek"): ("Ανδρέας", "Γιώργος", "Νίκος", "Πέτρος"), ("f", "greek"): ("Άννα", "Ελένη", "Μαρία", "Σοφία"), ("n", "greek"): ("Αλέξης", "Χριστός"),
    ("m", "armenian"): ("Արամ", "Հակոբ", "Տիգրան"), ("f", "armenian"): ("Անի", "Մարիամ", "Նարե"), ("n", "armenian"): ("Արփի", "Նուր"),
}
SYLLABLES = {"latin": ("ba", "den", "fal", "gor", "hal", "jen", "kel", "lam", "mor", "nis", "pel", "ros", "sten", "tor", "vik", "wal"),
             "cyrillic": ("ба", "ден", "гор", "кал", "лев", "мир", "нов", "пет", "рос", "сав", "тор", "ур", "фед", "хом", "чер", "яр"),
             "greek": ("βα", "δεν", "γορ", "καλ", "λεβ", "μιρ", "νομ", "πετ", "ροσ", "σαβ", "τορ", "φιλ", "χαρ", "ψαλ", "ζεν", "ραν"),
             "armenian": ("բա", "դեն", "գոր", "կալ", "լեվ", "միր", "նով", "պետ", "րոս", "սավ", "տոր", "ֆիլ", "խար", "զեն", "րան", "վար")}
#: Letters that stand for letters, by script: small ones, and capitals where the script has them.
LETTERS = {
    "Latin": ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), "Cyrillic": ("абвгдежзиклмнопрстуфхцчшэюя", "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ"),
    "Greek": ("αβγδεζηθικλμνξοπρστυφχψω", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ"), "Armenian": ("աբգդեզէըթժիլխծկհձղճմյնշոչպջռսվտրցփքօֆ", "ԱԲԳԴԵԶԷԸԹԺԻԼԽԾԿՀՁՂՃՄՅՆՇՈՉՊՋՌՍՎՏՐՑՓՔՕՖ"),
    "Hebrew": ("אבגדהוזחטיכלמנסעפצקרשת", ""), "Arabic": ("ابتثجحخدذرزسشصضطظعغفقكلمنهوي", ""), "Devanagari": ("कखगघचछजझटठडढणतथदधनपफबभमयरलवशषसह", ""), "Thai": ("กขคงจฉชซญดตถทธนบปผพภมยรลวสหอ", ""),
    "Hangul": ("가나다라마바사아자차카타파하고노도로모보소오조초코토포호", ""), "Hiragana": ("あいうえおかきくけこさしすせそたちつてとなにぬねの", ""), "Katakana": ("アイウエオカキクケコサシスセソタチツテトナニヌネノ", ""), "Han": ("天地人山水火木金土日月風雨花草石田林森川海雪雲星", ""),
}
#: issuers' ranges of card numbers, with the lengths that they issue.
ISSUED = r"4\d{12}(?:\d{3}){0,2}|(?:5[1-5]\d\d|222[1-9]|22[3-9]\d|2[3-6]\d\d|27[01]\d|2720)\d{12}|3[47]\d{13}|3(?:0[0-5]|09|[689]\d)\d{11}|(?:6011|65\d\d|64[4-9]\d|352[89]|35[3-8]\d|62\d\d)\d{12,15}|(?:5018|5020|5038|5893|6304|6759|676[1-3])\d{9,15}"

_TITLE = "|".join(t for names in TITLES.values() for t in names)
#: A word of a name; a possessive 's is not part of it.
_WORD = r"\p{Lu}(?:[\p{L}\p{M}]+|'[\p{L}\p{M}]+)(?:-[\p{L}\p{M}]+|['’][\p{L}\p{M}]{2,})*+"
#: What assigns a secret, and its value: up to the closing quote, or else up to white space, a quote, an angle bracket or
#: the next assignment of a list, without punctuation at its end. Repetition is possessive, so length costs no stack.
_ASSIGNED = r"(?i:token|secret|password|passwd|api[_-]?key|access[_-]?key)\\?[\"']?\s*+[=:]{1,2}>?\s*+"
_QUOTED = r"\"(?:[^\"\\\r\n]|\\.)++\"|'(?:[^'\\\r\n]|\\.)++'"
_BARE = r"(?:(?![&;,][\w.-]{1,32}=)[.,;:!?)\]}\\]*+[^\s\"'<>.,;:!?)\]}\\])++"
#: Phones: after a plus, groups with 5 digits or more in all, or 7 or more without a separator; else dotted forms and forms after a 1.
_PLUS = r"\+(?=\d{1,6}[ .(-]|\d{7})(?=(?:[ .()-]{0,2}\d){5})\d{1,15}(?:[ .-]\d(?=[ .-]\d\d))?(?:[ .-]?\(\d{1,4}\)[ .-]?\d{2,12}|[ .-]\d{2,12}){0,6}(?!\d)"
_NATIONAL = r"1[ .-]?\(\d{3}\)[ .-]?\d{3}[ .-]?\d{4}|1[ .-]\d{3}[ .-]\d{3}[ .-]\d{4}|\d{3}\.\d{3}\.\d{4}"
#: Emails: a host name has 127 labels at most.
PATTERNS = {
    "email": rf"(?<![{_L}._%+-])[{_L}][{_L}._%+-]*+@[{_L}-]++(?:\.[{_L}-]++){{0,126}}\.\p{{L}}{{2,}}",
    "secret": rf"{_EDGE}{_ASSIGNED}(?:{_QUOTED}|\\?[\"']?{_BARE})",
    "phone": rf"(?<![{_L}+]){_PLUS}|(?<![{_L}])\(\d{{3}}\)[ .-]?\d{{3}}[ .-]\d{{4}}(?!\d)|(?<![{_L}-])\d{{3}}-\d{{3}}-\d{{4}}(?![\d-])|(?<![{_L}+.-])(?:{_NATIONAL})(?!\d|[.-]\d)",
    "ssn": r"(?<![\p{L}\p{N}-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "card": r"(?<![\p{L}\p{N}.-])(?:\d{4}(?:[ -]\d{4}){3}|\d{13,19})(?![\p{L}\p{N}])",
    "ip": rf"(?<![{_L}.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?\d)",
    "name": rf"{_EDGE}(?:{_TITLE})\.? {_WORD}(?: {_WORD})?",
}
UNION = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: What every match holds; read before the patterns are tried.
HINT = rf"[\d@]|[=:]|{_TITLE}"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def _luhn(digits: Column, doubled_first: bool) -> Column:
    """Luhn sum of digits read from the right; the rightmost is doubled if `doubled_first`."""
    ordered = F.split(F.reverse(digits), "")
    twice = lambda d: F.when(d * 2 > 9, d * 2 - 9).otherwise(d * 2)
    values = F.transform(F.filter(ordered, lambda c: c != ""), lambda c, i: F.when((i % 2 == 1) != F.lit(doubled_first), twice(c.cast("int"))).otherwise(c.cast("int")))
    return F.aggregate(values, F.lit(0), lambda a, v: a + v)


def entity_type(mention: Column) -> Column:
    """The kind of a match of UNION, by the pattern that it fits whole; null for numbers that fail the Luhn sum or that no
    issuer gives out, and for secrets without a letter or digit."""
    fits = lambda kind: mention.rlike(rf"^(?:{PATTERNS[kind]})$")
    found = F.when(fits("email"), F.lit("email"))
    for kind in ("secret", "phone", "ssn", "ip", "name"):
        found = found.when(fits(kind) & F.regexp_extract(mention, _VALUE, 2).rlike(r"[\p{L}\p{N}]") if kind == "secret" else fits(kind), F.lit(kind))
    return found.when(fits("card") & _digits(mention).rlike(f"^(?:{ISSUED})$") & (_luhn(_digits(mention), False) % 10 == 0), F.lit("card"))


_VALUE = rf"^(?s)({_ASSIGNED}(?:\\?[\"'])?)(.+?)([\"']?)$"
_NAME = rf"^({_TITLE})(\.? )(.*)$"


def _entity(kind: str | Column, entity: Column) -> Column:
    return F.struct((F.lit(kind) if isinstance(kind, str) else kind).alias("kind"), entity.alias("entity"))


def entities_of(kind: Column, mention: Column) -> Column:
    """The entities that a mention is made of, as (kind, entity): what all mentions of one have in common.

    A name is a family name and, before it, a given name with its gender (of the title, else of the list of given names);
    a phone number is told with and without the country code 1. All other mentions are one entity.
    """
    title, full = F.regexp_extract(mention, _NAME, 1), F.regexp_extract(mention, _NAME, 3)
    given, family = F.lower(F.substring_index(full, " ", 1)), F.lower(F.substring_index(full, " ", -1))
    listed = lambda g: given.isin(*(n.lower() for (gender, _), names in GIVEN.items() if gender == g for n in names))
    gender = F.when(title.isin(*TITLES["m"]), "m").when(title.isin(*TITLES["f"]), "f").when(listed("m"), "m").when(listed("f"), "f").otherwise("n")
    last = _entity("family", family)
    name = F.when(full.contains(" "), F.array(_entity("given", F.concat(gender, F.lit(" "), given)), last)).otherwise(F.array(last))
    digits = _digits(mention)
    phone = F.when((F.length(digits) == 11) & digits.startswith("1"), F.substr(digits, F.lit(2), F.lit(10))).otherwise(digits)
    single = (
        F.when(kind == "email", F.lower(mention)).when(kind == "phone", phone).when(kind.isin("ssn", "card"), digits).when(kind == "secret", F.regexp_extract(mention, _VALUE, 2)).otherwise(mention)
    )
    return F.when(kind == "name", name).otherwise(F.array(_entity(kind, single)))


def _let(value: Column, body) -> Column:
    """body(value) with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _drawn(h: Column, i: int) -> Column:
    """The i-th number (0 to 255) of a hexadecimal digest."""
    return F.conv(F.substring(h, 2 * i + 1, 2), 16, 10).cast("int")


def _same_shape(text: Column, h: Column, hexadecimal: Column) -> Column:
    """Letters for letters of the same script and case, digits for digits, the rest as it is. Every 64 characters have a digest of their own."""
    pages = F.transform(F.sequence(F.lit(0), F.floor(F.length(text) / 64).cast("int")), lambda k: F.sha2(F.concat_ws("|", h, k.cast("string")), 512))
    small, capital = LETTERS["Latin"]

    def letters(c: Column) -> Column:
        made = F.when(c.rlike(r"^\d$"), "0123456789").when(c.rlike("^[A-Z]$"), F.when(hexadecimal, "ABCDEF").otherwise(capital)).when(c.rlike("^[a-z]$"), F.when(hexadecimal, "abcdef").otherwise(small)).when(~c.rlike(r"^\p{L}$"), "")
        for script, (low, high) in LETTERS.items():
            made = made.when(c.rlike(rf"^\p{{Is{script}}}$"), F.when(c.rlike(r"^\p{Lu}$"), high).otherwise(low) if high else low)
        return made.otherwise(F.when(c.rlike(r"^\p{Lu}$"), capital).otherwise(small))

    def filled(page: Column) -> Column:
        def put(c: Column, i: Column) -> Column:
            n = F.conv(F.substr(F.element_at(page, (i / 64).cast("int") + 1), (i % 64) * 2 + 1, F.lit(2)), 16, 10).cast("int")
            return _let(letters(c), lambda own: F.when(own == "", c).otherwise(F.substr(own, n % F.greatest(F.length(own), F.lit(1)) + 1, F.lit(1))))

        return F.array_join(F.transform(F.filter(F.split(text, ""), lambda c: c != ""), put), "")

    return _let(pages, filled)


def _one_of(values: tuple[str, ...], h: Column, i: int) -> Column:
    return F.element_at(F.split(F.lit(" ".join(values)), " "), _drawn(h, i) % len(values) + 1)


def _by_script(entity: Column, made) -> Column:
    """made(script) for the script that the entity is written in; Latin if it is none of those with names of their own."""
    found = None
    for script in ("cyrillic", "greek", "armenian"):
        at = entity.rlike(rf"\p{{Is{script.title()}}}")
        found = F.when(at, made(script)) if found is None else found.when(at, made(script))
    return found.otherwise(made("latin"))


def surrogate(key: str, kind: Column, entity: Column, attempt: Column) -> Column:
    """The replacement of an entity; `attempt` counts the collisions it has had.

    The first attempts keep the entity's format. From the fourth on the space grows by a character or more an attempt,
    whatever the kind, so that any number of entities finds values of its own.
    """
    mac = lambda *parts: F.sha2(F.concat_ws("|", F.lit(key), *parts), 512)
    h = mac(kind, entity, attempt.cast("string"))
    late = F.greatest(attempt - 2, F.lit(0))
    spare = F.substr(F.regexp_replace(mac(F.lit("spare"), h), "[a-f]", ""), F.lit(1), late)  # late digits
    size = F.length(entity)
    local, host = F.substring_index(entity, "@", 1), F.substring_index(entity, "@", -1)
    code = F.greatest(size - 10, F.lit(0))
    # what is redrawn in the shape that it has, for every kind in one place
    shape = F.when(kind == "email", local).when(kind == "phone", F.substr(entity, code + 1, size)).when(kind == "card", F.substr(entity, F.lit(2), size - 2)).when(kind.isin("ssn", "secret"), entity).otherwise("")
    alike = _same_shape(shape, h, (kind == "secret") & entity.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"))
    labels = F.when(kind == "email", F.regexp_replace(host, r"\.[^.]*$", "")).otherwise("")
    email = F.concat(alike, spare, F.lit("@"), _same_shape(labels, mac(F.lit("host"), host), F.lit(False)), F.lit(".example"))
    phone = F.concat(F.substr(entity, F.lit(1), code), alike, spare)
    body = F.concat(F.substr(entity, F.lit(1), F.lit(1)), alike, spare)
    card = F.concat(body, ((10 - _luhn(body, True) % 10) % 10).cast("string"))
    byte = lambda i: _drawn(h, i).cast("string")
    private = F.concat_ws(".", F.lit("10"), byte(0), byte(1), (_drawn(h, 2) % 254 + 1).cast("string"))
    reserved = F.concat_ws(".", (_drawn(h, 3) % 15 + 240).cast("string"), byte(0), byte(1), byte(2))
    local_six = F.concat(F.lit("fd"), F.substring(h, 1, 2), *(F.concat(F.lit(":"), F.substring(h, 4 * k + 3, 4)) for k in range(7)))
    ip = F.when(attempt < 3, private).when(attempt < 6, reserved).otherwise(local_six)
    secret = F.when(attempt > 2, F.concat(F.substring(h, 1, 24), spare)).otherwise(alike)
    gender = F.substr(entity, F.lit(1), F.lit(1))

    def syllables(script: str, first: int, least: int) -> Column:
        count = F.least(F.lit(least) + attempt, F.lit(40))
        picked = lambda k: F.element_at(F.split(F.lit(" ".join(SYLLABLES[script])), " "), F.conv(F.substr(h, (k + first) * 2 + 1, F.lit(2)), 16, 10).cast("int") % len(SYLLABLES[script]) + 1)
        return F.when(count > 0, F.array_join(F.transform(F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))), picked), "")).otherwise("")

    def given(script: str) -> Column:
        listed = F.when(gender == "m", _one_of(GIVEN["m", script], h, 0)).when(gender == "f", _one_of(GIVEN["f", script], h, 0)).otherwise(_one_of(GIVEN["n", script], h, 0))
        return F.concat(gender, F.lit(" "), F.lower(listed), syllables(script, 1, 0))

    first, last = _by_script(entity, given), _by_script(entity, lambda script: syllables(script, 0, 3))
    return (
        F.when(kind == "email", email).when(kind == "phone", phone).when(kind == "ssn", F.concat(alike, spare)).when(kind == "card", card).when(kind == "ip", ip)
        .when(kind == "secret", secret).when(kind == "given", first).otherwise(last)
    )


def render(kind: Column, mention: Column, values: Column) -> Column:
    """Surrogates (of the entities of a mention, in order) in the format of the mention: its separators, its case, its title.

    Digits that a value lacks (a country code) stay, digits that it has beyond those of the mention follow at the end.
    """
    value = F.element_at(values, 1)
    chars = F.filter(F.split(mention, ""), lambda c: c != "")
    more = F.length(_digits(mention)) - F.length(value)
    digit = lambda i: F.length(_digits(F.substr(mention, F.lit(1), i + 1))) - F.greatest(more, F.lit(0))
    inside = F.array_join(F.transform(chars, lambda c, i: F.when(c.rlike(r"^\d$") & (digit(i) > 0), F.substr(value, digit(i), F.lit(1))).otherwise(c)), "")
    filled = F.concat(inside, F.when(more < 0, F.substr(value, F.length(value) + more + 1, -more)).otherwise(F.lit("")))
    shout = lambda text: (text == F.upper(text)) & (text != F.lower(text)) & (F.length(text) > 1)
    full = F.regexp_extract(mention, _NAME, 3)
    old = F.transform(F.split(full, " "), lambda w: F.trim(w))
    called = F.transform(values, lambda v, i: F.when(shout(F.element_at(old, i + 1)), F.upper(F.regexp_replace(v, "^[mfn] ", ""))).otherwise(F.initcap(F.regexp_replace(v, "^[mfn] ", ""))))
    return (
        F.when(kind.isin("phone", "ssn", "card"), filled).when(kind == "email", F.when(shout(mention), F.upper(value)).otherwise(value))
        .when(kind == "secret", F.concat(F.regexp_extract(mention, _VALUE, 1), value, F.regexp_extract(mention, _VALUE, 3)))
        .when(kind == "name", F.concat(F.regexp_extract(mention, _NAME, 1), F.regexp_extract(mention, _NAME, 2), F.array_join(called, " "))).otherwise(value)
    )


def surrogate_table(entities: DataFrame, key: str) -> DataFrame:
    """(kind, entity, value) for distinct `entities` (kind, entity): values differ from each other, from their own entity
    and, but for given names, from every other entity.

    A value that two entities drew goes to the first of them, and one that is an entity itself to none; the others
    draw again, from a space that grows, until no collision is left. Each round compares by a shuffle on the value.
    """
    now = staged(entities.distinct().withColumn("attempt", F.lit(0)), "entities")
    while True:
        drawn = now.withColumn("value", surrogate(key, F.col("kind"), F.col("entity"), F.col("attempt")))
        ranked = drawn.withColumn("_rank", F.row_number().over(W.partitionBy("kind", "value").orderBy("attempt", "entity")))
        taken = now.filter("kind <> 'given'").select("kind", F.col("entity").alias("value"), F.lit(True).alias("_taken"))
        checked = staged(ranked.join(taken, ["kind", "value"], "left").withColumn("again", (F.col("_rank") > 1) | F.col("_taken").isNotNull() | (F.col("value") == F.col("entity"))).select("kind", "entity", "attempt", "value", "again"), "surrogates")
        unstage(now)
        if checked.filter("again").isEmpty():
            return checked.select("kind", "entity", "value")
        now = staged(checked.select("kind", "entity", (F.col("attempt") + F.col("again").cast("int")).alias("attempt")), "entities")
        unstage(checked)


#: Over how many places the texts of one mention are dealt.
SALTS = 16


def _untitled(mention: Column, new: Column) -> Column:
    """What a titled name (and its surrogate) is called without the title: in full, by its last and by its first word, also in capitals."""
    old, now = F.regexp_extract(mention, _NAME, 3), F.regexp_extract(new, _NAME, 3)
    pair = lambda a, b: F.struct(a.alias("old"), b.alias("new"))
    pairs = F.array(pair(old, now), *(pair(F.substring_index(old, " ", k), F.substring_index(now, " ", k)) for k in (-1, 1)))
    return F.concat(pairs, F.transform(pairs, lambda p: pair(F.upper(p["old"]), F.upper(p["new"]))))


def _renamed(part: Column, pattern: Column, names: Column) -> Column:
    """(text, n): a piece of text with the matches of `pattern` replaced by the map `names`."""
    found, between = F.regexp_extract_all(part, pattern, F.lit(0)), F.split(part, pattern, -1)
    follow = F.flatten(F.transform(found, lambda m, i: F.array(F.element_at(names, m), F.element_at(between, i + 2))))
    return F.struct(F.array_join(F.concat(F.array(F.element_at(between, 1)), follow), "").alias("text"), F.size(found).alias("n"))


def pseudonymise(docs: DataFrame, key: str = "provenir") -> DataFrame:
    """`docs` with personal data and secrets in `text` replaced, and n_replaced (long), the places replaced.

    Emails, phone numbers, social security and card numbers (Luhn-valid, in an issuer's range), IPv4 addresses, assigned
    secrets and names after a title are detected in whole texts, very long ones too; a secret is the whole value, of any
    length, that holds a letter or digit. A surrogate has its entity's type, gender, script and format.
    A name that stands after a title is replaced in the whole of its text: with and without the title, in full, by its
    first and by its last word (persons of one text that share such a word share what the first by order gets). One entity has one surrogate in all documents and all its formats;
    two entities never share one; the same key gives the same surrogates. Null texts stay null, texts without an
    entity come back unchanged, repeated rows are treated alike; other columns pass; an empty table gives no rows.
    """
    text = F.col("text")
    mentions = F.regexp_extract_all(text, F.lit(UNION), F.lit(0))
    flagged = F.coalesce(text.rlike(HINT) & text.rlike(UNION), F.lit(False))
    kept = [c for c in docs.columns if c != "n_replaced"]
    marked = docs.select("text", F.struct(*kept).alias("_row"), flagged.alias("_flag"))
    held = staged(marked.filter("_flag").select("text", "_row", F.md5("text").alias("_key"), mentions.alias("_found")), "mentions")
    seen = staged(held.select("_key", F.explode("_found").alias("mention")).distinct(), "seen")
    told = seen.select("mention").distinct().withColumn("kind", entity_type(F.col("mention"))).filter("kind is not null")
    parts = staged(told.select("mention", "kind", F.posexplode(entities_of(F.col("kind"), F.col("mention"))).alias("_at", "_e")).select("mention", "kind", "_at", F.col("_e.kind").alias("_kind"), F.col("_e.entity").alias("entity")), "parts")
    table = surrogate_table(parts.select(F.col("_kind").alias("kind"), "entity"), key).withColumnRenamed("kind", "_kind")
    valued = parts.join(table, ["_kind", "entity"]).groupBy("mention", "kind").agg(F.transform(F.array_sort(F.collect_list(F.struct("_at", "value"))), lambda v: v["value"]).alias("_values"))
    renamed = valued.select("mention", "kind", render(F.col("kind"), F.col("mention"), F.col("_values")).alias("new"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    changed = seen.withColumn("_salt", F.pmod(F.xxhash64("_key"), F.lit(SALTS)).cast("int")).join(renamed, ["mention", "_salt"]).select("_key", "kind", "mention", "new")
    calls = F.flatten(F.array_sort(F.collect_list(F.when(F.col("kind") == "name", _untitled(F.col("mention"), F.col("new"))))))
    by_text = changed.groupBy("_key").agg(F.map_from_entries(F.collect_list(F.struct("mention", "new"))).alias("_new"), calls.alias("_calls"))
    longest = F.array_sort(F.array_distinct(F.transform("_calls", lambda c: F.struct((-F.length(c["old"])).alias("k"), c["old"].alias("old")))))
    first = F.transform(longest, lambda w: F.struct(w["old"], F.element_at(F.filter("_calls", lambda c: c["old"] == w["old"]), 1)["new"]))
    pattern = F.concat(F.lit(f"{_EDGE}(?:"), F.array_join(F.transform(longest, lambda w: w["old"]), "|"), F.lit(rf")(?![{_L}\p{{M}}])"))
    by_text = by_text.select("_key", "_new", F.map_from_entries(first).alias("_names"), F.when(F.size("_calls") > 0, pattern).alias("_pattern"))
    none = F.create_map().cast("map<string,string>")
    whole = F.transform(F.split("text", UNION, -1), lambda part: F.struct(part.alias("text"), F.lit(0).alias("n")))
    parts = F.when(F.col("_pattern").isNull(), whole).otherwise(F.transform(F.split("text", UNION, -1), lambda part: _renamed(part, F.col("_pattern"), F.col("_names"))))
    joined = held.join(by_text, "_key", "left").select("_row", "_found", parts.alias("_parts"), F.coalesce("_new", none).alias("_map"))
    follow = F.flatten(F.transform("_found", lambda m, i: F.array(F.coalesce(F.try_element_at("_map", m), m), F.element_at("_parts", i + 2)["text"])))
    untitled = F.aggregate("_parts", F.lit(0), lambda n, part: n + part["n"])
    filled = joined.select(
        F.col("_row").withField("text", F.array_join(F.concat(F.array(F.element_at("_parts", 1)["text"]), follow), "")).alias("_row"),
        (F.size(F.filter("_found", lambda m: F.try_element_at("_map", m).isNotNull())) + untitled).cast("long").alias("n_replaced"),
    )
    rest = marked.filter("not _flag").select("_row", F.lit(0).cast("long").alias("n_replaced"))
    return rest.unionByName(filled).select("_row.*", "n_replaced")
