"""Versioned tables: immutable Parquet parts under numbered manifests.

A manifest says which parts a version adds and removes; every CHECKPOINT-th lists all of them. A commit writes the next manifest and succeeds for one
writer only, since creating a file that exists fails; a reader resolves the newest version once and keeps reading its parts, whatever is committed later. Appends
add parts and copy nothing.

Tables with ``key_buckets`` keep rows in parts by a hash of the key. A merge then rewrites the buckets that the source touches and keeps the
others' parts, so its cost follows the change and not the table. A large bucket has several files, in order of the key. Parts remember the range of a column where
it was known, so that a scan for a range opens no others. ``compact`` joins small parts and fits the number of buckets to the rows, ``vacuum``
removes what only older versions read.
"""

from __future__ import annotations

import json
import uuid
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MANIFESTS = "_manifests"
#: Versions between full lists of parts.
CHECKPOINT = 16
#: Rows that a bucket should hold, and files that one may gather before it is compacted.
BUCKET_ROWS, SMALL_PARTS = 2_000_000, 8


class CommitConflict(RuntimeError):
    """Another writer has committed this version."""


class DuplicateSourceKey(ValueError):
    """Several source rows match on one key."""


def _observed(seen: Observation, again: DataFrame) -> dict[str, int]:
    """What was observed while rows were written. A plan that turns out empty at run time is cut down with its observation; the same counts are then taken from
    ``again``, one row."""
    try:
        return seen.get
    except Py4JJavaError:
        return again.first().asDict()


@dataclass(frozen=True)
class MergeCounts:
    num_inserted_rows: int = 0
    num_updated_rows: int = 0
    num_deleted_rows: int = 0


@dataclass
class Manifest:
    version: int
    schema: dict
    key_buckets: int = 0
    parts: list[dict] = field(default_factory=list)


class VersionedTable:
    """A table at a path. key and key_buckets matter where merges are to rewrite buckets only; an existing table has the number of buckets that its manifest names."""

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str] = (), key_buckets: int = 0):
        self.spark, self.path, self.key, self.first_buckets = spark, path.rstrip("/"), tuple(key), key_buckets if key else 0

    # files

    def _fs(self):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{MANIFESTS}")
        return where, where.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _file(self, version: int) -> str:
        return f"{self.path}/{MANIFESTS}/{version:012d}.json"

    def versions(self) -> list[int]:
        where, fs = self._fs()
        if not fs.exists(where):
            return []
        names = (s.getPath().getName() for s in fs.listStatus(where))
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def exists(self) -> bool:
        return bool(self.versions())

    def _load(self, version: int) -> dict:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self._file(version))
        stream = self._fs()[1].open(path)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def manifest(self, version: int | None = None) -> Manifest:
        have = self.versions()
        if not have or version is not None and version not in have:
            raise FileNotFoundError(f"no version {version if version is not None else ''} of a table at {self.path}")
        at = have[-1] if version is None else version
        steps = [self._load(at)]
        while not steps[-1]["full"]:
            steps.append(self._load(steps[-1]["version"] - 1))
        parts: dict[str, dict] = {}
        for step in reversed(steps):
            for path in step["removed"]:
                parts.pop(path, None)
            parts |= {p["path"]: p for p in step["added"]}
        return Manifest(at, steps[0]["schema"], steps[0]["key_buckets"], list(parts.values()))

    def _commit(self, before: Manifest | None, schema: StructType, key_buckets: int, parts: list[dict]) -> int:
        """Writes the next manifest under a name of its own, then takes its version by renaming it, which fails if the version is taken."""
        version, old = (before.version + 1, before.parts) if before else (1, [])
        full, had, has = version % CHECKPOINT == 1 or not before, {p["path"] for p in old}, {p["path"] for p in parts}
        step = {"version": version, "schema": json.loads(schema.json()), "key_buckets": key_buckets, "full": full, "added": parts if full else [p for p in parts if p["path"] not in had], "removed": [] if full else sorted(had - has)}
        _, fs = self._fs()
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        held = path(f"{self.path}/{MANIFESTS}/.{uuid.uuid4().hex}")
        out = fs.create(held, False)
        out.write(bytearray(json.dumps(step).encode()))
        out.close()
        target = path(self._file(version))
        if fs.exists(target) or not fs.rename(held, target):
            fs.delete(held, False)
            raise CommitConflict(f"version {version} of {self.path} exists")
        return version

    def _write(self, df: DataFrame, buckets: int, known: dict[str, list] | None = None) -> list[dict]:
        """The new parts of these rows. known: the range of a column's values in them."""
        name = f"part-{uuid.uuid4().hex}"
        if not buckets:
            df.write.parquet(f"{self.path}/{name}")
            return [{"path": name, "bucket": None, "known": known or {}}]
        # rebalancing splits a large bucket into several files, where a repartition would give it one task and one file
        dealt = df.withColumn("_bucket", self._bucket(buckets)).hint("rebalance", "_bucket").sortWithinPartitions("_bucket", *self.key)
        dealt.write.partitionBy("_bucket").parquet(f"{self.path}/{name}")
        where = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        found = [s.getPath().getName() for s in where.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(where)]
        return [{"path": f"{name}/{n}", "bucket": int(n.partition("=")[2]), "known": known or {}} for n in sorted(found) if n.startswith("_bucket=")]

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.hash(*map(F.col, self.key)), F.lit(buckets))

    def _touched(self, m: Manifest, df: DataFrame) -> set[int]:
        """The buckets of these rows' keys: a number for each bucket at most."""
        return {r[0] for r in df.select(self._bucket(m.key_buckets)).distinct().collect()}

    def _read(self, schema: StructType, parts: list[dict]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.path}/{p['path']}" for p in parts))

    # operations

    def read(self, version: int | None = None) -> DataFrame:
        m = self.manifest(version)
        return self._read(StructType.fromJson(m.schema), m.parts)

    def read_for(self, df: DataFrame) -> DataFrame:
        """The rows of the buckets that these rows' keys fall into; all rows where the table has no buckets."""
        m = self.manifest()
        parts = m.parts
        if m.key_buckets:
            numbers = self._touched(m, df)
            parts = [p for p in parts if p["bucket"] in numbers]
        return self._read(StructType.fromJson(m.schema), parts)

    def read_within(self, column: str, least, most) -> DataFrame:
        """The rows whose value lies in the range; parts known to lie beyond it aren't opened."""
        m = self.manifest()
        beyond = lambda p: column in p["known"] and (p["known"][column][1] < least or p["known"][column][0] > most)
        rows = self._read(StructType.fromJson(m.schema), [] if least is None else [p for p in m.parts if not beyond(p)])
        return rows if least is None else rows.where(F.col(column).between(least, most))

    def overwrite(self, df: DataFrame) -> int:
        m = self.manifest() if self.exists() else None
        buckets = m.key_buckets if m else self.first_buckets
        return self._commit(m, df.schema, buckets, self._write(df, buckets))

    def append(self, df: DataFrame, known: dict[str, list] | None = None) -> int:
        m = self.manifest() if self.exists() else None
        schema, buckets = (StructType.fromJson(m.schema), m.key_buckets) if m else (df.schema, self.first_buckets)
        return self._commit(m, schema, buckets, [*(m.parts if m else []), *self._write(df.select(*schema.names), buckets, known)])

    def insert_absent(self, df: DataFrame, on: Sequence[str], within: str | None = None) -> int:
        """Appends the rows whose key no row of the table has; a null in the key equals nothing, so such rows are always appended. Returns their number.

        within: an integer column of the key whose values in a batch lie close together. Its least and greatest there are fetched first, so that the table's
        scan can leave out parts, files and row groups beyond them."""
        seen, fresh, known = Observation(), df, {}
        if within:
            least, most = df.agg(F.min(within), F.max(within)).first()
            # rows without a value are appended too, which a range can't tell
            if least is not None and not df.where(F.col(within).isNull()).take(1):
                known = {within: [least, most]}
        if self.exists():
            held = (self.read_within(within, least, most) if within else self.read()).select(*on)
            fresh = df.join(held, list(on), "left_anti").select(*df.columns)
        self.append(fresh.observe(seen, F.count(F.lit(1)).alias("n")), known)
        # the table of ``fresh`` is the version read above, so a second count sees the same rows
        return _observed(seen, fresh.agg(F.count(F.lit(1)).alias("n")))["n"]

    def save_as(self, name: str, path: str | None = None) -> None:
        """The newest version as a table of the session's catalog, replaced if it is there; with its files at the path, or else in the warehouse."""
        writer = self.read().write.mode("overwrite")
        (writer.option("path", path) if path else writer).saveAsTable(name)

    # upkeep

    def compact(self, bucket_rows: int = BUCKET_ROWS, small_parts: int = SMALL_PARTS) -> int:
        """Joins parts where there are over ``small_parts`` for a bucket (or in all, without buckets), and doubles the number of buckets while one holds over ``bucket_rows``
        rows on average. Rows stay the same. Returns the number of parts that were replaced."""
        m = self.manifest()
        schema, buckets = StructType.fromJson(m.schema), m.key_buckets
        if buckets:
            rows = self._read(schema, m.parts).count()
            while rows > buckets * bucket_rows:
                buckets *= 2
        counts = Counter(p["bucket"] for p in m.parts)
        old = [p for p in m.parts if buckets != m.key_buckets or counts[p["bucket"]] > small_parts]
        if not old:
            return 0
        rows, kept = self._read(schema, old), [p for p in m.parts if p not in old]
        ranges = [p["known"] for p in old]
        known = {c: [min(r[c][0] for r in ranges), max(r[c][1] for r in ranges)] for c in ranges[0] if all(c in r for r in ranges)}
        parts = self._write(rows if buckets else rows.hint("rebalance"), buckets, known)
        self._commit(m, schema, buckets, [*kept, *parts])
        return len(old)

    def vacuum(self, keep: int = 1) -> int:
        """Removes manifests older than the last ``keep`` versions and parts that none of those reads; returns the number of removed parts. No reader may use older versions then."""
        have = self.versions()
        kept = have[-keep:]
        used = {p["path"].partition("/")[0] for v in kept for p in self.manifest(v).parts}
        # the full list that the oldest kept version builds on has to stay
        base = max(v for v in have if v <= kept[0] and self._load(v)["full"])
        where, fs = self._fs()
        path, removed = self.spark._jvm.org.apache.hadoop.fs.Path, 0
        for v in have:
            if v < base:
                fs.delete(path(self._file(v)), False)
        for status in fs.listStatus(path(self.path)):
            name = status.getPath().getName()
            if name.startswith("part-") and name not in used:
                fs.delete(status.getPath(), True)
                removed += 1
        return removed

    def merge(self, source: DataFrame, on: Sequence[str], update: str | None = None, delete: str | None = None, insert: str | None = None) -> MergeCounts:
        """Conditions are SQL over s.* and t.*; the first that holds of update and delete counts for a matched row, insert for an unmatched one.

        The source must hold one row at most for each key and be cheap to read again (it is read three times)."""
        twice = source.dropna(subset=list(on)).groupBy(*on).count().where("count > 1").limit(1)
        if not twice.isEmpty():
            raise DuplicateSourceKey(f"several source rows for one {', '.join(on)}")
        m = self.manifest() if self.exists() else None
        schema = StructType.fromJson(m.schema) if m else source.schema
        buckets = m.key_buckets if m else self.first_buckets
        touched, kept = m.parts if m else [], []
        if m and buckets and tuple(on) == self.key:
            numbers = self._touched(m, source)
            touched, kept = [p for p in m.parts if p["bucket"] in numbers], [p for p in m.parts if p["bucket"] not in numbers]
        t = self._read(schema, touched).withColumn("_in_t", F.lit(True)).alias("t")
        s = source.withColumn("_in_s", F.lit(True)).alias("s")
        both = t.join(s, F.expr(" AND ".join(f"t.`{k}` = s.`{k}`" for k in on)), "full_outer")
        yes = lambda condition: F.coalesce(F.expr(condition), F.lit(False)) if condition else F.lit(False)
        matched = F.col("t._in_t").isNotNull() & F.col("s._in_s").isNotNull()
        action = (
            F.when(matched, F.when(yes(update), "update").when(yes(delete), "delete").otherwise("keep"))
            .when(F.col("t._in_t").isNotNull(), "keep")
            .otherwise(F.when(yes(insert), "insert").otherwise("skip"))
        )
        new = F.col("_action").isin("update", "insert")
        seen = Observation()
        counts = [F.count_if(F.col("_action") == a).alias(a) for a in ("insert", "update", "delete")]
        acted = both.withColumn("_action", action)
        rows = acted.observe(seen, *counts)
        out = rows.where(F.col("_action").isin("keep", "update", "insert")).select(*(F.when(new, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in schema.names))
        parts = self._write(out, buckets)
        self._commit(m, schema, buckets, [*kept, *parts])
        done = _observed(seen, acted.agg(*counts))
        return MergeCounts(done["insert"], done["update"], done["delete"])
