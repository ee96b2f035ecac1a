"""MinHash near-duplicates by a multi-index Hamming join over b-bit signatures.

A document's set holds its distinct shingles of ``words`` neighbouring words (A-Z lower-cased; the whole sequence where it is
shorter). ``HASHES`` minimum hashes, 16 bits each, are its signature. The signature is cut into chunks; if two signatures differ in at most
``farthest(percent)`` places, some chunk differs in at most one (pigeonhole), so keys of every chunk with each one place left out bring together
all pairs within the distance. A pair of the wanted similarity is beyond that distance about once in a million. Links are confirmed on full sets.

Documents with equal sets count once. Each key's documents are first held against the one of them whose keys are shared most, which in a group of
edited copies is the text nearest to the others. Keys whose documents are then all of one component are done. For the documents of the other
keys an exact prefix filter names the pairs of different components that can link at all: a pair of sizes x and y needs
o = percent (x + y) / (100 + percent) common shingles, so the x - o + 1 rarest shingles of one and the y - o + 1 rarest of the other must meet. Shingles of one component only count
as rarest, since no other component has them. So copies aren't expanded into all pairs, and yet no link between different components is missed.

Null and empty texts and texts without words have an empty set and link with nothing. Rows are judged by their own text: equal rows have one class, and where an id has
several texts each row has its text's class. A row without an id belongs to the class of an equal set but is never kept. Empty tables give no rows. Further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, components, map_batches, mix

WORDS = 5
PERCENT = 80
HASHES = 128
#: Standard deviations from a linked pair's mean distance within which it is searched.
DEVIATIONS = 4.75
REMEMBERED = 50_000
_rng = np.random.default_rng(20)
_ODD = _rng.integers(0, 1 << 63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)
_MUL = _rng.integers(0, 1 << 63, (HASHES,), np.uint64) * np.uint64(2) + np.uint64(1)
_KEY = _rng.integers(0, 1 << 63, (HASHES,), np.uint64)
_STEP = _rng.integers(0, 1 << 63, (64,), np.uint64) * np.uint64(2) + np.uint64(1)


def farthest(percent: int) -> int:
    """The signature distance up to which every pair is found."""
    s = percent / 100
    return min(HASHES, math.floor(HASHES * (1 - s) + DEVIATIONS * math.sqrt(HASHES * s * (1 - s))))


def bounds(percent: int) -> np.ndarray:
    """The chunks' ends: so many chunks that the distance's errors leave one with at most one error."""
    chunks = min(HASHES, farthest(percent) // 2 + 1)
    return np.linspace(0, HASHES, chunks + 1).round().astype(int)


class Shingler:
    """Sorted 64-bit hashes of a text's distinct shingles; remembers words' hashes."""

    def __init__(self, words: int):
        self.words, self.known = words, {}

    def set_of(self, text: str | None) -> np.ndarray:
        words = (text or "").encode().lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        for w in set(words):
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        size = min(self.words, len(h))
        out = np.full(len(h) - size + 1, size, np.uint64)
        for i in range(size):
            out = mix(out * _STEP[i % 64] + h[i : len(h) - size + 1 + i])
        return np.unique(out)


def signature(shingles: np.ndarray) -> np.ndarray:
    low = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 1024):
        np.minimum(low, np.multiply.outer(shingles[at : at + 1024], _ODD).min(0), out=low)
    return (mix(low) >> np.uint64(48)).astype(np.uint16)


def keys_of(signatures: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Keys of each signature: for each chunk and each place left out, a hash of the chunk's other places."""
    terms = signatures.astype(np.uint64) * _MUL
    sums = np.add.reduceat(terms, ends[:-1], axis=1)
    return mix(np.repeat(sums, np.diff(ends), axis=1) - terms + _KEY)


def _sums(shingles: np.ndarray) -> tuple[int, int]:
    """Two 64-bit numbers that tell sets apart."""
    return int(mix(shingles + np.uint64(1)).sum(dtype=np.uint64).view(np.int64)), int(np.bitwise_xor.reduce(shingles).view(np.int64))


def _signed(docs: DataFrame, words: int) -> DataFrame:
    """(id, n, sum, xor, sig) of every row; nulls for an empty set."""
    own: list[Shingler] = []

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not own:
            own.append(Shingler(words))
        n, sums, signs = [], [], []
        for x in batch.column(1):
            s = own[0].set_of(x.as_py())
            n.append(len(s))
            sums.append(_sums(s) if len(s) else (None, None))
            signs.append(signature(s).tobytes() if len(s) else None)
        return pa.record_batch([batch.column(0), pa.array(n, pa.int64()), pa.array([x for x, _ in sums], pa.int64()), pa.array([x for _, x in sums], pa.int64()), pa.array(signs, pa.binary())], names=["id", "n", "sum", "xor", "sig"])

    return map_batches(docs.select("id", "text"), run, "id long, n long, sum long, xor long, sig binary")


def _keys(sets: DataFrame, percent: int) -> DataFrame:
    """(key, node), one row for each key of each signature."""
    ends = bounds(percent)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        signs = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint16).reshape(-1, HASHES)
        return pa.record_batch([pa.array(keys_of(signs, ends).view(np.int64).ravel()), pa.array(np.repeat(batch.column("node").to_numpy(), HASHES))], names=["key", "node"])

    return map_batches(sets.select("node", "sig"), run, "key long, node long")


def _full(docs: DataFrame, needed: DataFrame, words: int) -> DataFrame:
    """(node, n, sig, shingles) of the needed sets, from the texts of their ids."""
    own: list[Shingler] = []

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        if not own:
            own.append(Shingler(words))
        rows = []
        for node, n, first, second, sig, text in zip(*(batch.column(c).to_pylist() for c in ("node", "n", "sum", "xor", "sig")), batch.column("text"), strict=True):
            s = own[0].set_of(text.as_py())
            if len(s) == n and _sums(s) == (first, second):
                rows.append((node, n, sig, s.tobytes()))
        if not rows:
            return None
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["node", "n", "sig", "shingles"])

    texts = docs.join(needed, "id").select("node", "n", "sum", "xor", "sig", "text")
    return map_batches(texts, run, "node long, n long, sig binary, shingles binary").dropDuplicates(["node"])


def _confirmed(pairs: DataFrame, full: DataFrame, scratch: Scratch, percent: int) -> DataFrame:
    """The pairs (a, b) whose signatures are within the distance and whose full sets have at least that percentage in common."""
    most = farthest(percent)

    def near(batch: pa.RecordBatch) -> pa.RecordBatch:
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, HASHES) for c in ("sig_a", "sig_b"))
        keep = pa.array((a != b).sum(1) <= most)
        return pa.record_batch([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])

    last: list = [None, None]

    def linked(batch: pa.RecordBatch) -> pa.RecordBatch:
        good = []
        for a, x, y in zip(batch.column("a").to_pylist(), batch.column("x_a"), batch.column("x_b"), strict=True):
            if last[0] != a:
                last[:] = [a, np.frombuffer(x.as_py(), np.uint64)]
            x, y = last[1], np.frombuffer(y.as_py(), np.uint64)
            common = len(np.intersect1d(x, y, assume_unique=True))
            good.append(100 * common >= percent * (len(x) + len(y) - common))
        keep = pa.array(good, pa.bool_())
        return pa.record_batch([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])

    side = lambda p, c: full.select(F.col("node").alias(p), F.col("n").alias(f"n_{p}"), F.col(c).alias(f"x_{p}"))
    sized = pairs.join(side("a", "sig").withColumnRenamed("x_a", "sig_a"), "a").join(side("b", "sig").withColumnRenamed("x_b", "sig_b"), "b")
    close = scratch.cut(map_batches(sized.where(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)").select("a", "b", "sig_a", "sig_b"), near, "a long, b long"))
    both = close.join(side("b", "shingles"), "b").join(side("a", "shingles"), "a").select("a", "b", "x_a", "x_b")
    out = scratch.cut(map_batches(both, linked, "a long, b long"))
    scratch.drop(close)
    return out


def _shingles(full: DataFrame) -> DataFrame:
    """(node, n, component, h), one row for each shingle."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = batch.column("n").to_numpy()
        many = [pa.array(np.repeat(batch.column(c).to_numpy(), n)) for c in ("node", "n", "component")]
        return pa.record_batch([*many, pa.array(np.frombuffer(b"".join(batch.column("shingles").to_pylist()), np.int64))], names=["node", "n", "component", "h"])

    return map_batches(full.select("node", "n", "component", "shingles"), run, "node long, n long, component long, h long")


def _unsettled(full: DataFrame, scratch: Scratch, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that the prefix filter cannot rule out. full has a component for each node."""
    each = _shingles(full)
    common = scratch.cut(each.groupBy("h").agg(F.count("*").alias("c"), F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("h", "c"))
    by_rarity = Window.partitionBy("node").orderBy("c", "h")
    ranked = each.hint("merge").join(common, "h", "left").withColumn("c", F.coalesce("c", F.lit(0))).withColumn("place", F.row_number().over(by_rarity) - 1)
    prefix = scratch.cut(ranked.where(f"c > 0 AND 100 * place <= {100 - percent} * n").select("node", "n", "component", "h", "place"))
    # a shingle's largest component is held against the others' documents only
    sizes = prefix.groupBy("h", "component").agg(F.count("*").alias("m"))
    mains = sizes.groupBy("h").agg(F.max(F.struct("m", "component")).alias("main"), F.count("*").alias("c")).where("c > 1").select("h", F.col("main.component").alias("main"))
    mains = scratch.cut(mains)
    outside = scratch.cut(prefix.join(mains, "h").where("component <> main"))
    other = prefix.select("h", *(F.col(c).alias(f"y_{c}") for c in ("node", "n", "component", "place")))
    needed = f"(({percent} * (n + y_n) + {99 + percent}) div {100 + percent})"
    able = f"component <> y_component AND (y_component = main OR node < y_node) AND place <= n - {needed} AND y_place <= y_n - {needed} AND 100 * least(n, y_n) >= {percent} * greatest(n, y_n)"
    pairs = outside.join(other, "h").where(able).select(F.least("node", "y_node").alias("a"), F.greatest("node", "y_node").alias("b")).distinct()
    out = scratch.cut(pairs)
    scratch.drop(common, prefix, mains, outside)
    return out


def near_duplicates(df: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row: component_id is the smallest id reachable over links of at least ``percent`` per cent similarity."""
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    signed = scratch.cut(_signed(docs, words))
    # a node is a set; numbers are given once and written
    equal = signed.where("sig IS NOT NULL AND id IS NOT NULL").groupBy("n", "sum", "xor", "sig").agg(F.min("id").alias("id"))
    sets = scratch.cut(equal.withColumn("node", F.monotonically_increasing_id()))
    keys = _keys(sets, percent)
    # aggregates are written before they are joined: a join of two plain shuffles is one whose hot keys adaptive execution can split. The hint: Spark takes what a map
    # gives for as small as its source, and would broadcast the keys of a table of a few MB
    often = scratch.cut(keys.groupBy("key").agg(F.count("*").alias("c")).where("c > 1"))
    shared = scratch.cut(keys.hint("merge").join(often, "key"))
    scratch.drop(often)
    weights = shared.groupBy("node").agg(F.sum("c").alias("weight"))
    full = scratch.cut(_full(docs, sets.join(weights.select("node"), "node", "left_semi"), words))
    weighed = shared.join(weights, "node")
    hubs = scratch.cut(weighed.groupBy("key").agg(F.max(F.struct("weight", "node")).alias("hub")).select("key", F.col("hub.node").alias("hub")))
    first = shared.join(hubs, "key").where("node <> hub").select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
    links = _confirmed(first, full, scratch, percent)
    found = scratch.cut(components(links, scratch))
    placed = shared.join(found, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    placed = scratch.cut(placed)
    unsettled = scratch.cut(placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key"))
    left = scratch.cut(placed.join(unsettled, "key", "left_semi").select("node", "component").distinct())
    scratch.drop(shared, hubs, placed, unsettled)
    pairs = _unsettled(full.join(left, "node"), scratch, percent)
    more = _confirmed(pairs, full, scratch, percent)
    joined = scratch.cut(components(links.unionByName(more), scratch))
    scratch.drop(full, links, found, left, pairs, more)
    classes = sets.join(joined, "node", "left").select("n", "sum", "xor", "id", F.coalesce("component", "node").alias("component"))
    least = scratch.cut(classes.groupBy("component").agg(F.min("id").alias("component_id")))
    named = scratch.cut(classes.join(least, "component").select("n", "sum", "xor", "component_id"))
    scratch.drop(sets, joined, least)
    out = signed.select("id", "n", "sum", "xor").join(named, ["n", "sum", "xor"], "left").withColumn("component_id", F.coalesce("component_id", "id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
