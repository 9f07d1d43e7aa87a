"""Versioned tables of Parquet snapshots: optimistic transactions, buckets by key, secondary indexes."""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import cached_property

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import INDEXES, KEYS, TABLES, empty

MOST_BUCKETS, MOST_TRIES = 1 << 16, 20
CONDITIONAL = "fs.option.create.conditional.overwrite"


class StaleWrite(RuntimeError):
    """Another writer changed what this one had read; read again and redo the change."""


class DuplicateKey(ValueError):
    """Rows of a change share a key, or have none."""


class _Taken(RuntimeError):
    """Another writer created the version first."""


@dataclass
class Upserted:
    """A change of some rows of a table, one row a key: they take the place of the rows of their keys.

    `columns`: where the key is known, only these are taken. `keep`: where the key is known, the old row stays.
    """

    rows: DataFrame
    columns: tuple[str, ...] | None = None
    keep: bool = False


def _bucket(column: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(buckets)).cast("int")


class Snapshot:
    """All tables as one version has them."""

    def __init__(self, store: Store, pointer: dict):
        self.store, self.pointer = store, pointer
        self.version: int = pointer["version"]

    @cached_property
    def notes(self) -> dict:
        return self.pointer.get("notes", {})

    def manifest(self, name: str) -> dict | None:
        """Buckets of a table: their number, and path and rows of each that holds rows; the same of its indexes."""
        at = self.pointer["tables"].get(name)
        return self.store._load(at) if at else None

    def read(self, name: str, buckets: Iterable[int] | None = None) -> DataFrame:
        """A table, or the rows of some of its buckets; no other file is opened."""
        return self._frame(self.manifest(name), buckets, TABLES[name])

    def _frame(self, manifest: dict | None, buckets: Iterable[int] | None, schema: str) -> DataFrame:
        parts = manifest["parts"] if manifest else {}
        picked = parts.values() if buckets is None else [parts[k] for b in buckets if (k := str(b)) in parts]
        paths = [f"{self.store.root}/{p['path']}" for p in picked]
        spark = self.store.spark
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.read(name) for name in TABLES}

    def _met(self, values: DataFrame, column: str, buckets: int) -> list[int]:
        """The buckets that `values` fall in: a list of `buckets` numbers at most."""
        return [r[0] for r in values.select(_bucket(column, buckets).alias("b")).distinct().collect()]

    def with_keys(self, name: str, keys: DataFrame) -> DataFrame:
        """The rows whose key is among `keys` (a column named like it), from the buckets that such keys fall in."""
        key, manifest = KEYS[name], self.manifest(name)
        if not manifest:
            return empty(self.store.spark, name)
        return self.read(name, self._met(keys, key, manifest["buckets"])).join(keys.select(key).distinct(), key, "left_semi").select(*empty(self.store.spark, name).columns)

    def lookup(self, name: str, column: str, values: DataFrame) -> DataFrame:
        """The rows whose indexed `column` is among `values` (a column of that name): by the index's buckets of these
        values, then by the table's buckets of the keys found there. Null is no value."""
        manifest, key = self.manifest(name), KEYS[name]
        if not manifest:
            return empty(self.store.spark, name)
        index = manifest["indexes"][column]
        wanted = values.filter(F.col(column).isNotNull()).select(column).distinct()
        entries = self._frame(index, self._met(wanted, column, index["buckets"]), f"{column} string, {key} string")
        return self.with_keys(name, entries.join(wanted, column, "left_semi").select(key))

    def commit(self, changes: dict[str, DataFrame | Upserted], notes: dict | None = None, reads: Iterable[str] | None = None) -> int:
        """Commits `changes` that were made on this version. `reads`: the tables they depend on (all, if not told)."""
        return self.store.commit(changes, notes, self.version, TABLES if reads is None else reads)


class Store:
    """Tables of `schemas.TABLES` below `root` (any file system that Spark reads).

    A table is cut into buckets by a hash of its key, about `bucket_rows` rows each. A commit writes the buckets it
    changes as new files, keeps the others, and then creates a pointer of its own, `CURRENT.<version>.json`, which must not
    exist yet. Nothing is written over: readers take the largest pointer, so a commit that fails at any step leaves the last
    version in place.

    Concurrency is optimistic. A commit names the version it was made on; if versions that came since changed a table that it
    depends on, it fails with `StaleWrite`. A pure upsert depends on no table and is merged with the newer version instead. Where
    `base` is not told, a commit is made on the versions that this store object has read since its last commit.
    """

    def __init__(self, spark: SparkSession, root: str, bucket_rows: int = 100_000):
        self.spark, self.root, self.bucket_rows = spark, root.rstrip("/"), bucket_rows
        self._read_at: dict[str, int] = {}

    def _path(self, name: str):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _load(self, name: str) -> dict:
        path, fs = self._path(name)
        source = fs.open(path)
        try:
            return json.loads(bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(source)))
        finally:
            source.close()

    def _save(self, name: str, content: dict) -> str:
        path, fs = self._path(name)
        out = fs.create(path, False)
        out.write(bytearray(json.dumps(content).encode()))
        out.close()
        return name

    def version(self) -> int:
        """The last version that is whole; 0 for none."""
        path, fs = self._path("")
        if not fs.exists(path):
            return 0
        found = (re.fullmatch(r"CURRENT\.(\d+)\.json", s.getPath().getName()) for s in fs.listStatus(path))
        return max((int(m[1]) for m in found if m), default=0)

    def snapshot(self, version: int | None = None) -> Snapshot:
        version = self.version() if version is None else version
        return Snapshot(self, self._load(f"CURRENT.{version}.json") if version else {"version": 0, "tables": {}})

    def read(self, name: str) -> DataFrame:
        now = self.snapshot()
        self._read_at.setdefault(name, now.version)
        return now.read(name)

    def tables(self) -> dict[str, DataFrame]:
        """Every table, all of one version."""
        now = self.snapshot()
        for name in TABLES:
            self._read_at.setdefault(name, now.version)
        return now.tables()

    def notes(self) -> dict:
        return self.snapshot().notes

    def commit(self, changes: dict[str, DataFrame | Upserted], notes: dict | None = None, base: int | None = None, reads: Iterable[str] | None = None) -> int:
        """Makes `changes` the next version: a frame replaces a table, `Upserted` some of its rows. `notes` are kept beside the
        pointer.

        `base`: the version they were made on; `reads`: the tables they depend on (with a `base`, those changed, if not
        told). A replaced table always counts as read. Raises `StaleWrite` if one of them has changed since.
        """
        read_at = dict(self._read_at) if base is None else {name: base for name in (changes if reads is None else reads)}
        if base is None and reads is not None:
            read_at = {name: at for name, at in read_at.items() if name in set(reads)}
        replaced = {name for name, change in changes.items() if not isinstance(change, Upserted)}
        start = self.version()
        for name in replaced:
            read_at.setdefault(name, start if base is None else base)
        token, deltas, done = uuid.uuid4().hex[:12], {}, {}
        for _ in range(MOST_TRIES):
            now = self.snapshot()
            self._refuse_stale(read_at, now)

            def written(name: str) -> tuple[str | None, dict | None]:
                if name not in replaced:
                    return self._merged(now, name, changes[name], token, deltas, done.get(name))
                return done.get(name) or (self._replaced(name, changes[name], token), None)

            with ThreadPoolExecutor(max(1, len(changes))) as pool:  # jobs of different tables run side by side
                done = dict(zip(changes, pool.map(inheritable_thread_target(self.spark)(written), changes)))
            tables = now.pointer["tables"] | {name: made for name, (made, _) in done.items() if made}
            changed = sorted(name for name, (made, _) in done.items() if made)
            try:
                self._publish(now.version + 1, {"version": now.version + 1, "tables": tables, "changed": changed, "notes": now.notes | (notes or {})})
            except _Taken:
                continue
            self._read_at.clear()
            for at in deltas.values():
                self._drop(at)
            return now.version + 1
        raise StaleWrite(f"{MOST_TRIES} other writers came first")

    def _refuse_stale(self, read_at: dict[str, int], now: Snapshot) -> None:
        for version in range(min(read_at.values(), default=now.version) + 1, now.version + 1):
            pointer = now.pointer if version == now.version else self._load(f"CURRENT.{version}.json")
            for name in pointer["changed"]:
                if name in read_at and read_at[name] < version:
                    raise StaleWrite(f"version {version} changed {name}, which was read at version {read_at[name]}")

    def _typed(self, name: str, rows: DataFrame) -> DataFrame:
        return rows.select(*(rows[f.name].cast(f.dataType).alias(f.name) for f in empty(self.spark, name).schema))

    def _written(self, rows: DataFrame, column: str, buckets: int, at: str) -> dict[str, dict]:
        """Writes rows by bucket of `column` below `at`; path of each bucket that holds a row."""
        rows.withColumn("bucket", _bucket(column, buckets)).repartition("bucket").write.partitionBy("bucket").parquet(f"{self.root}/{at}")
        path, fs = self._path(at)
        names = (s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory())
        return {n.split("=")[1]: {"path": f"{at}/{n}"} for n in names if n.startswith("bucket=")}

    def _counted(self, name: str, parts: dict[str, dict], buckets: int) -> int:
        """Adds the rows of each bucket to `parts`; refuses a key that repeats or is null."""
        key = KEYS[name]
        if not parts:
            return 0
        rows = self.spark.read.schema(f"{key} string").parquet(*(f"{self.root}/{p['path']}" for p in parts.values()))
        by_key = rows.groupBy(key).agg(F.count("*").alias("n"))
        per = by_key.groupBy(_bucket(key, buckets).alias("b")).agg(F.sum("n").alias("n"), F.max("n").alias("most"), F.max(F.col(key).isNull()).alias("none"))
        for r in per.collect():
            if r["most"] > 1 or r["none"]:
                raise DuplicateKey(f"{name}: a {key} is null or repeats")
            parts[str(r["b"])]["rows"] = r["n"]
        return sum(p["rows"] for p in parts.values())

    def _fitting(self, rows: int) -> int:
        """A power of two of buckets."""
        wanted = max(1, -(-rows // self.bucket_rows))
        return min(MOST_BUCKETS, 1 << (wanted - 1).bit_length())

    def _replaced(self, name: str, rows: DataFrame, token: str) -> str:
        """A table written anew, with its indexes; its manifest."""
        held = f"{name}/{token}-whole"
        self._typed(name, rows).write.parquet(f"{self.root}/{held}")
        frame = self.spark.read.schema(TABLES[name]).parquet(f"{self.root}/{held}")
        buckets = self._fitting(frame.count())
        parts = self._written(frame, KEYS[name], buckets, f"{name}/{token}")
        total = self._counted(name, parts, buckets)
        indexes = {}
        for column in INDEXES.get(name, ()):
            entries = frame.filter(F.col(column).isNotNull()).select(column, KEYS[name])
            indexes[column] = {"buckets": buckets, "parts": self._written(entries, column, buckets, f"{name}/{token}-{column}")}
        self._drop(held)
        return self._save(f"{name}/{token}.json", {"buckets": buckets, "rows": total, "parts": parts, "indexes": indexes})

    def _merged(self, now: Snapshot, name: str, change: Upserted, token: str, deltas: dict[str, str], before: tuple | None) -> tuple[str | None, dict | None]:
        """The manifest after an upsert, and the parts of the version that it was made of. What an earlier try wrote is taken if
        the buckets are the same; the rows to upsert are computed once."""
        key, manifest = KEYS[name], now.manifest(name)
        buckets = manifest["buckets"] if manifest else self._fitting(0)
        if before and before[1] == manifest:
            return before
        if name not in deltas:
            deltas[name] = f"{name}/{token}-delta"
            self._typed(name, change.rows).write.parquet(f"{self.root}/{deltas[name]}")
        delta = self.spark.read.schema(TABLES[name]).parquet(f"{self.root}/{deltas[name]}")
        incoming = delta.groupBy(key).agg(F.count("*").alias("n")).groupBy(_bucket(key, buckets).alias("b")).agg(F.sum("n").alias("n"), F.max("n").alias("most"), F.max(F.col(key).isNull()).alias("none")).collect()
        if any(r["most"] > 1 or r["none"] for r in incoming):
            raise DuplicateKey(f"{name}: a {key} is null or repeats")
        if not incoming:
            return None, manifest
        grown = (manifest["rows"] if manifest else 0) + sum(r["n"] for r in incoming)
        attempt = uuid.uuid4().hex[:6]
        if not manifest or self._fitting(grown) > 2 * buckets:  # too few buckets: all are cut anew
            return self._replaced(name, self._upserted(now.read(name), delta, key, change), f"{token}-{attempt}"), manifest
        touched = [r["b"] for r in incoming]
        old = now.read(name, touched)
        made = self._upserted(old, delta, key, change)
        parts = self._written(made, key, buckets, f"{name}/{token}-{attempt}")
        self._counted(name, parts, buckets)
        merged = manifest["parts"] | parts
        indexes = dict(manifest["indexes"])
        for column in INDEXES.get(name, ()):
            indexes[column] = self._reindexed(now, indexes[column], column, key, old, self.spark.read.schema(TABLES[name]).parquet(*(f"{self.root}/{p['path']}" for p in parts.values())), delta, f"{name}/{token}-{attempt}-{column}")
        return self._save(f"{name}/{token}-{attempt}.json", {"buckets": buckets, "rows": sum(p["rows"] for p in merged.values()), "parts": merged, "indexes": indexes}), manifest

    @staticmethod
    def _upserted(old: DataFrame, delta: DataFrame, key: str, change: Upserted) -> DataFrame:
        if change.keep or change.columns is not None:
            taken = () if change.keep else change.columns
            fresh = delta.select(F.col(key).alias("_key"), F.lit(True).alias("_seen"), *(F.col(c).alias(f"_{c}") for c in taken))
            joined = old.join(fresh, old[key] == fresh["_key"], "left")
            kept = joined.select(*(F.when(F.col("_seen"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in taken else F.col(c) for c in old.columns))
            return kept.unionByName(delta.join(old.select(key), key, "left_anti"))
        return old.join(delta.select(key), key, "left_anti").unionByName(delta)

    def _reindexed(self, now: Snapshot, index: dict, column: str, key: str, old: DataFrame, new: DataFrame, delta: DataFrame, at: str) -> dict:
        """An index after an upsert: only the buckets of values that changed rows had or have are written."""
        keys = delta.select(key)
        entries = lambda rows: rows.join(keys, key, "left_semi").filter(F.col(column).isNotNull()).select(column, key)
        before, after = entries(old), entries(new)
        gone, come = before.exceptAll(after), after.exceptAll(before)
        touched = now._met(gone.unionByName(come), column, index["buckets"])
        if not touched:
            return index
        kept = now._frame(index, touched, f"{column} string, {key} string").join(gone, [column, key], "left_anti")
        parts = self._written(kept.unionByName(come), column, index["buckets"], at)
        emptied = {str(b) for b in touched} - set(parts)
        return {"buckets": index["buckets"], "parts": {b: p for b, p in index["parts"].items() if b not in emptied} | parts}

    def _drop(self, name: str) -> None:
        path, fs = self._path(name)
        fs.delete(path, True)

    def _publish(self, version: int, pointer: dict) -> None:
        """Creates the pointer whole, or raises `_Taken`: of many writers of one version one succeeds.

        On local disks a hard link fails where the name exists; stores with conditional writes create on that condition;
        elsewhere (as on HDFS) a rename to a name that exists is refused by the file system.
        """
        content = bytearray(json.dumps(pointer).encode())
        final, fs = self._path(f"CURRENT.{version}.json")
        if fs.hasPathCapability(final, CONDITIONAL):
            try:
                builder = fs.createFile(final).overwrite(False)
                builder.must(CONDITIONAL, "true")
                out = builder.build()
                out.write(content)
                out.close()
            except Exception as e:
                if fs.exists(final):
                    raise _Taken(str(version)) from e
                raise
            return
        draft, _ = self._path(f"draft-{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        out.write(content)
        out.close()
        try:
            if fs.getScheme() == "file":
                os.link(draft.toUri().getPath(), final.toUri().getPath())
            elif fs.exists(final) or not fs.rename(draft, final):
                raise FileExistsError(version)
        except FileExistsError as e:
            raise _Taken(str(version)) from e
        finally:
            fs.delete(draft, False)

    def vacuum(self, keep: int = 2) -> int:
        """Removes what none of the last `keep` versions refers to, pointers of older versions included; how many entries.
        To be called while no one writes or reads older versions."""
        newest = self.version()
        held, kept = set(), [v for v in range(max(1, newest - keep + 1), newest + 1)]
        for v in kept:
            for at in self._load(f"CURRENT.{v}.json")["tables"].values():
                manifest = self._load(at)
                held.add(at)
                for parts in (manifest["parts"], *(i["parts"] for i in manifest["indexes"].values())):
                    held.update(p["path"].rsplit("/", 1)[0] for p in parts.values())
        gone = 0
        for name in TABLES:
            path, fs = self._path(name)
            for s in fs.listStatus(path) if fs.exists(path) else []:
                at = f"{name}/{s.getPath().getName()}"
                if at not in held:
                    gone += fs.delete(s.getPath(), True)
        path, fs = self._path("")
        for s in fs.listStatus(path) if fs.exists(path) else []:
            found = re.fullmatch(r"CURRENT\.(\d+)\.json", s.getPath().getName())
            if found and int(found[1]) not in kept:
                gone += fs.delete(s.getPath(), False)
        return gone
