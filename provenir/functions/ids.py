"""Deterministic identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the namespace of name-based identifiers.
NAMESPACE = "55a45f42-cbd5-4f91-a2e3-665fd125ba16"


def uuid5(name: Column, namespace: str = NAMESPACE) -> Column:
    """The name-based (SHA-1) UUID of a text."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(name, "UTF-8")))
    piece = lambda at, n: F.substring(h, at, n)
    variant = F.substr(F.lit("89ab"), (F.conv(piece(17, 1), 16, 10).cast("int") % 4 + 1), F.lit(1))
    return F.concat_ws("-", piece(1, 8), piece(9, 4), F.concat(F.lit("5"), piece(14, 3)), F.concat(variant, piece(18, 3)), piece(21, 12))


def stable_id(kind: str, *parts: Column) -> Column:
    """Identifier of `kind` from parts in normal form; null parts vanish, empty ones stay."""
    return uuid5(F.concat(F.lit(f"{kind}|"), F.concat_ws("|", *parts)))


def content_hash(content: Column) -> Column:
    return F.sha2(content, 256)


def weekly_run_id(source_id: Column, day: Column) -> Column:
    """One identifier a source and ISO week."""
    year, week = F.extract(F.lit("YEAROFWEEK"), day), F.weekofyear(day)
    return stable_id("run", source_id, year.cast("string"), week.cast("string"))
