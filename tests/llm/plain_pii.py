"""A plain version of the PII operator: one text after the other, one entity after the other, no Spark."""

import hashlib

import regex

from provenir.llm import pii

EDGE = r"(?<![\p{L}\p{N}])"


def mac(key, *parts):
    return hashlib.sha512("|".join([key, *parts]).encode()).hexdigest()


def byte(h, i):
    return int(h[2 * i : 2 * i + 2], 16)


def luhn(digits, doubled_first):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        if (i % 2 == 1) != doubled_first:
            d = d * 2 - 9 if d * 2 > 9 else d * 2
        total += d
    return total


def script_of(c):
    return next((s for s in pii.LETTERS if regex.fullmatch(rf"\p{{Script={s}}}", c)), None)


def same_shape(text, h, hexadecimal=False):
    out = []
    for i, c in enumerate(text):
        n = byte(hashlib.sha512(f"{h}|{i // 64}".encode()).hexdigest(), i % 64)
        if c.isascii() and c.isdigit():
            letters = "0123456789"
        elif regex.fullmatch(r"\p{L}", c):
            small, capital = ("abcdef", "ABCDEF") if hexadecimal and script_of(c) == "Latin" else pii.LETTERS.get(script_of(c), pii.LETTERS["Latin"])
            letters = capital if c.isupper() and capital else small
        else:
            out.append(c)
            continue
        out.append(letters[n % len(letters)])
    return "".join(out)


def kind_of(mention):
    fits = lambda kind: regex.fullmatch(pii.PATTERNS[kind], mention)
    if fits("email"):
        return "email"
    if fits("secret"):
        return "secret" if regex.search(r"[\p{L}\p{N}]", regex.match(pii._VALUE, mention)[2]) else None
    for kind in ("phone", "ssn", "ip", "name"):
        if fits(kind):
            return kind
    digits = regex.sub(r"\D", "", mention)
    return "card" if fits("card") and regex.fullmatch(pii.ISSUED, digits) and luhn(digits, False) % 10 == 0 else None


def entities_of(kind, mention):
    digits = regex.sub(r"\D", "", mention)
    if kind == "name":
        title, _, full = regex.match(pii._NAME, mention).groups()
        gender = next((g for g in "mf" if title in pii.TITLES[g]), None)
        given, *rest = full.lower().split(" ")
        gender = gender or next((g for g in "mf" if any(given == n.lower() for (k, _), names in pii.GIVEN.items() if k == g for n in names)), "n")
        return [("given", f"{gender} {given}"), ("family", rest[-1])] if rest else [("family", given)]
    if kind == "phone" and len(digits) == 11 and digits[0] == "1":
        return [("phone", digits[1:])]
    return [(kind, {"email": mention.lower(), "phone": digits, "ssn": digits, "card": digits}.get(kind) or (regex.match(pii._VALUE, mention)[2] if kind == "secret" else mention))]


def surrogate(key, kind, entity, attempt):
    h = mac(key, kind, entity, str(attempt))
    spare = regex.sub("[a-f]", "", mac(key, "spare", h))[: max(attempt - 2, 0)]
    if kind == "email":
        local, host = entity.split("@")[0], entity.split("@")[-1]
        return f"{same_shape(local, h)}{spare}@{same_shape(host.rsplit('.', 1)[0], mac(key, 'host', host))}.example"
    if kind == "phone":
        code = max(len(entity) - 10, 0)
        return entity[:code] + same_shape(entity[code:], h) + spare
    if kind == "ssn":
        return same_shape(entity, h) + spare
    if kind == "card":
        body = entity[0] + same_shape(entity[1:-1], h) + spare
        return body + str((10 - luhn(body, True) % 10) % 10)
    if kind == "ip":
        if attempt < 3:
            return f"10.{byte(h, 0)}.{byte(h, 1)}.{byte(h, 2) % 254 + 1}"
        return f"{byte(h, 3) % 15 + 240}.{byte(h, 0)}.{byte(h, 1)}.{byte(h, 2)}" if attempt < 6 else "fd" + h[:2] + "".join(f":{h[4 * k + 2 : 4 * k + 6]}" for k in range(7))
    if kind == "secret":
        return h[:24] + spare if attempt > 2 else same_shape(entity, h, bool(regex.fullmatch("[0-9a-f]+|[0-9A-F]+", entity)))
    script = next((s for s in ("cyrillic", "greek", "armenian") if regex.search(rf"\p{{Script={s.title()}}}", entity)), "latin")
    syllables = lambda first, n: "".join(pii.SYLLABLES[script][byte(h, first + i) % 16] for i in range(n))
    if kind == "given":
        names = pii.GIVEN[entity[0], script]
        return f"{entity[0]} {names[byte(h, 0) % len(names)].lower()}{syllables(1, attempt)}"
    return syllables(0, 3 + attempt)


def table(entities, key):
    now = {e: 0 for e in entities}
    while True:
        drawn = {}
        for (kind, entity), attempt in now.items():
            drawn.setdefault((kind, surrogate(key, kind, entity, attempt)), []).append((attempt, entity.encode(), entity))
        again = [(kind, e[2]) for (kind, value), own in drawn.items() for i, e in enumerate(sorted(own)) if i or value == e[2] or (kind != "given" and (kind, value) in now)]
        if not again:
            return {(kind, own[0][2]): value for (kind, value), own in drawn.items()}
        for e in again:
            now[e] += 1


def shouted(text):
    return text == text.upper() != text.lower() and len(text) > 1


def render(kind, mention, values):
    value = values[0]
    if kind == "name":
        title, gap, full = regex.match(pii._NAME, mention).groups()
        plain = [regex.sub("^[mfn] ", "", v) for v in values]
        return title + gap + " ".join(v.upper() if shouted(old) else v.capitalize() for v, old in zip(plain, full.split(" ")))
    if kind in ("phone", "ssn", "card"):
        more = len(regex.sub(r"\D", "", mention)) - len(value)
        out, seen = [], 0
        for c in mention:
            seen += c.isascii() and c.isdigit()
            at = seen - max(more, 0)
            out.append(value[at - 1] if c.isascii() and c.isdigit() and at > 0 else c)
        return "".join(out) + (value[more:] if more < 0 else "")
    if kind == "email":
        return value.upper() if shouted(mention) else value
    if kind == "secret":
        before, _, after = regex.match(pii._VALUE, mention).groups()
        return before + value + after
    return value


def pseudonymise(texts, key="provenir"):
    union = regex.compile(pii.UNION)
    found = [[(m.start(), m.end(), m[0], kind_of(m[0])) for m in union.finditer(t)] if t else [] for t in texts]
    values = table({e for own in found for *_, m, kind in own if kind for e in entities_of(kind, m)}, key)
    out = []
    for text, own in zip(texts, found):
        if text is None:
            out.append((None, 0))
            continue
        new = {m: render(kind, m, [values[e] for e in entities_of(kind, m)]) for *_, m, kind in own if kind}
        calls = []
        for m in sorted(m for *_, m, kind in own if kind == "name"):
            old, now = regex.match(pii._NAME, m)[3], regex.match(pii._NAME, new[m])[3]
            pairs = [(old, now), (old.split(" ")[-1], now.split(" ")[-1]), (old.split(" ")[0], now.split(" ")[0])]
            calls.append(pairs + [(a.upper(), b.upper()) for a, b in pairs])
        names = {}
        for a, b in (p for pairs in sorted(calls) for p in pairs):
            names.setdefault(a, b)
        again = regex.compile(f"{EDGE}(?:{'|'.join(sorted(names, key=lambda w: (-len(w), w.encode())))})(?![\\p{{L}}\\p{{N}}\\p{{M}}])") if names else None
        made, at, n = [], 0, 0

        def between(piece):
            nonlocal n
            if not again:
                return piece
            n += len(again.findall(piece))
            return again.sub(lambda m: names[m[0]], piece)

        for start, end, m, _ in own:
            made += [between(text[at:start]), new.get(m, m)]
            n += m in new
            at = end
        out.append(("".join([*made, between(text[at:])]), n))
    return out
