"""Text: normal form, cleaning, keyword tests, fuzzy similarity."""

from __future__ import annotations

import html
import re
import unicodedata
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Unicode white space as Python's \s has it, for Java's regular expressions.
WHITE = r"(?U)[\s\x1c-\x1f]+"
_WORD = r"[\p{L}\p{N}_]"


def normal_form(text: str | None) -> str:
    """NFKC, case-folded, white space collapsed; empty for None."""
    return " ".join(unicodedata.normalize("NFKC", text).casefold().split()) if text else ""


@F.pandas_udf(T.StringType())
def normalize_text(text: pd.Series) -> pd.Series:
    """`normal_form` of a column. Java has no built-in NFKC, so the text goes through Arrow once."""
    return text.map(normal_form)


def normalize_ascii(text: Column) -> Column:
    """The normal form of ASCII text, without leaving the JVM."""
    return F.coalesce(F.trim(F.regexp_replace(F.lower(text), WHITE, " ")), F.lit(""))


class _Text(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []

    def handle_data(self, data: str) -> None:
        self.parts.append(data)


def plain_text(text: str | None) -> str | None:
    """Entities resolved, tags dropped, white space collapsed; None for nothing."""
    if not text:
        return None
    text = html.unescape(text)
    if "<" in text and ">" in text:
        parser = _Text()
        parser.feed(text)
        parser.close()
        text = " ".join(parser.parts)
    return re.sub(r"\s+", " ", text).strip() or None


@F.pandas_udf(T.StringType())
def _plain(text: pd.Series) -> pd.Series:
    return text.map(plain_text)


def clean_text(text: Column, most: int | None = None) -> Column:
    """`plain_text`, cut to `most` code points."""
    cleaned = _plain(text)
    return F.left(cleaned, F.lit(most)) if most else cleaned


def truthy(text: Column) -> Column:
    """The text, null if empty."""
    return F.nullif(text, F.lit(""))


def first_truthy(*texts: Column) -> Column:
    return F.coalesce(*(truthy(t) for t in texts))


def escaped(keyword: str) -> str:
    return re.sub(r"([.\\+*?\[^\]$(){}=!<>|:\-#/])", r"\\\1", keyword)


def keywords(words: tuple[str, ...]) -> str:
    """A pattern for any of `words` standing free of letters, digits and underscores."""
    return rf"(?<!{_WORD})(?:{'|'.join(escaped(w) for w in words)})(?!{_WORD})"


def bounded(pattern: str) -> str:
    r"""A pattern with \b replaced by what it means for Unicode words in Python."""
    return pattern.replace(r"\b", rf"(?:(?<={_WORD})(?!{_WORD})|(?<!{_WORD})(?={_WORD}))")


def western_digits(text: Column) -> Column:
    """Decimal digits of the scripts met most as ASCII digits."""
    return F.translate(text, "०१२३४५६७८९٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹০১২৩৪৫৬৭৮৯", "0123456789" * 4)


def _indel_similarity(a: str, b: str) -> float:
    """100 x twice the longest common subsequence over both lengths, by bit-parallel rows."""
    if not a and not b:
        return 100.0
    places: dict[str, int] = {}
    for i, ch in enumerate(a):
        places[ch] = places.get(ch, 0) | 1 << i
    row = (1 << len(a)) - 1
    full = row
    for ch in b:
        hit = row & places.get(ch, 0)
        row = ((row + hit) | (row - hit)) & full
    return 200.0 * (len(a) - row.bit_count()) / (len(a) + len(b))


def token_set_similarity(a: str | None, b: str | None) -> float:
    """Token-set similarity, 0 to 100: a name whose words are all in the other scores 100."""
    x, y = set((a or "").split()), set((b or "").split())
    if not x or not y:
        return 0.0
    both, left, right = sorted(x & y), sorted(x - y), sorted(y - x)
    if both and (not left or not right):
        return 100.0
    common = " ".join(both)
    one, two = (" ".join(filter(None, (common, " ".join(rest)))) for rest in (left, right))
    scores = [_indel_similarity(one, two)]
    if both:
        scores += [_indel_similarity(common, one), _indel_similarity(common, two)]
    return max(scores)


@F.pandas_udf(T.DoubleType())
def token_set_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([token_set_similarity(x, y) for x, y in zip(a, b)], dtype="float64")
