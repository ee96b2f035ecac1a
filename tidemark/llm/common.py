"""What the corpus operators share: reading, cutting lineage, Arrow maps, connected components."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BYTES, DEFAULT_BYTES, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "1m"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Without Hadoop's native library a JVM starts a ``chmod`` for each local file and each checksum file it makes, and until that has begun it counts as a second process with all
#: of the JVM's memory. Scratch tables on local disks have no checksum files.
LOCAL = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}
_left: list[tuple[SparkSession, str]] = []
_own: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a temporary one only where that setting is unset and all tasks run on this machine."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
    if not _own:
        _own.append("file://" + tempfile.mkdtemp(prefix="tidemark-"))
    return _own[0]


def _file_system(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())


def _delete(spark: SparkSession, path: str) -> None:
    _file_system(spark, path).delete(spark._jvm.org.apache.hadoop.fs.Path(path), True)


@atexit.register
def _clean() -> None:
    for spark, path in _left:
        try:
            _delete(spark, path)
        except Exception:  # the session has ended: the folder is the cluster's to clear
            pass


class Scratch:
    """Intermediate tables of one operator, written to the shared folder so that a lost executor costs no lineage.

    ``cut`` writes and rereads a frame; ``drop`` removes tables that no later plan reads. What the returned frame still
    reads is removed when the process ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def cut(self, df: DataFrame) -> DataFrame:
        path = f"{shared_folder(self.spark)}/tidemark-{uuid.uuid4().hex}"
        # the write's own shuffle files go as soon as it is done, not when the driver happens to collect garbage
        before = self.spark.conf.get(CLEANUP, "false")
        self.spark.conf.set(CLEANUP, "true")
        try:
            df.write.options(compression="zstd", **(LOCAL if _file_system(self.spark, path).getScheme() == "file" else {})).parquet(path)
        finally:
            self.spark.conf.set(CLEANUP, before)
        _left.append((self.spark, path))
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (out, path)
        return out

    def drop(self, *frames: DataFrame) -> None:
        for df in frames:
            _, path = self.paths.pop(id(df))
            _delete(self.spark, path)
            _left[:] = [x for x in _left if x[1] != path]


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of at most BATCH_BYTES and a row, where the session keeps Spark's default: memory on both sides follows the bytes, not the rows."""
    if spark.conf.get(BYTES) == DEFAULT_BYTES:
        spark.conf.set(BYTES, BATCH_BYTES)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """One Arrow batch in, one out; columns of the output in the order of the schema."""
    bound_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := fn(batch)) is not None:
                yield out

    return df.mapInArrow(run, schema)


def arrow_column(spark: SparkSession, fn: Callable[[pa.Array], pa.Array], kind: str) -> Callable[[Column], Column]:
    """A column computed from another by Arrow batches; the row's other columns stay in the JVM. Marked as not deterministic, since a filter on the column would be pushed
    below its projection otherwise and have every row computed twice."""
    bound_batches(spark)

    def run(column: pa.Array) -> pa.Array:
        return fn(column)

    return F.arrow_udf(run, returnType=kind).asNondeterministic()


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over all."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo the number of folds."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def near_fraction(key: Column, fraction: Column) -> Column:
    """True for about that share of keys, the same keys on every run and partitioning."""
    return F.pmod(F.xxhash64(F.lit(7), key), F.lit(1_000_000)) < fraction * 1_000_000


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) of every node that is not the smallest of its component: component is the smallest id reachable over columns a, b.

    Every node hooks to its smallest neighbour, parents are jumped over, and the graph of roots is contracted until no
    edge is left, so rounds grow with the logarithm of a component's size. Joins read written tables only, so that a
    hub's rows can be split by adaptive execution.
    """
    pairs = lambda df: df.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).where("lo < hi").distinct()
    left = scratch.cut(pairs(edges))
    found = None
    while not left.isEmpty():
        hook = scratch.cut(left.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("parent")))
        while True:
            up = hook.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
            jumped = scratch.cut(hook.join(up, "parent", "left").select("node", F.coalesce("above", "parent").alias("parent"), F.col("above").isNotNull().alias("moved")))
            scratch.drop(hook)
            hook = jumped
            if hook.where("moved").isEmpty():
                break
            hook = hook.select("node", "parent")
            scratch.paths[id(hook)] = (hook, scratch.paths.pop(id(jumped))[1])
        roots = hook.select("node", "parent")
        at = lambda df, c: df.join(roots.select(F.col("node").alias(c), F.col("parent").alias("to")), c, "left").withColumn(c, F.coalesce("to", c)).drop("to")
        mid = scratch.cut(at(left, "hi"))
        after = scratch.cut(pairs(at(mid, "lo").select(F.col("lo").alias("a"), F.col("hi").alias("b"))))
        scratch.drop(left, mid)
        left = after
        if found is None:
            found = scratch.cut(roots)
        else:
            up = roots.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
            moved = found.join(up, "parent", "left").select("node", F.coalesce("above", "parent").alias("parent"))
            more = scratch.cut(moved.unionByName(roots))
            scratch.drop(found)
            found = more
        scratch.drop(hook)
    scratch.drop(left)
    if found is None:
        return edges.sparkSession.createDataFrame([], "node long, component long")
    return found.select("node", F.col("parent").alias("component"))
