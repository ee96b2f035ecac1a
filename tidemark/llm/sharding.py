"""Shards by a k-d tree over document metadata, split at distributed weighted medians.

Equal texts form a group, which counts as one point: its bytes are its weight; its length, its least language and its least source are its
dimensions. Every node splits along its widest dimension, measured against the root's width, at the weighted
median, until a leaf holds no more than the target bytes. Points that are equal in that dimension are ordered by a hash of the text, so
that a split comes as near to one half as whole groups allow and groups stay whole. A group larger than
``whole`` shares of a leaf is cut into parts by a hash of doc_id, since no balanced split could hold it.

Medians are found from histograms over the order's 64-bit key, refined digit by digit: each pass collects at most ``DIGIT`` counts a node,
whatever the table's size. Everything is DataFrame operations.

Null text counts as empty for bytes and checksum; null language and source count as the empty string. Repeated rows are separate rows of one
group. Empty tables give no rows. Further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch

SHARDS = 8
#: Counts that one refinement of a median collects for each node.
DIGIT = 1 << 10
DIGIT_BITS = 10
#: Leading bits of the order's key: 16 of the dimension, then hash bits.
KEY_BITS = 60
#: A group of more than this part of a leaf's target bytes is cut.
WHOLE = 0.25
#: Bytes of a name that give its place.
NAME_BYTES = 7
#: Rows that one run of slot numbers holds.
RUN = 20_000
DIMENSIONS = ("length", "lang", "source")


def _groups(rows: DataFrame, target: int, whole: float) -> DataFrame:
    """One row for each group of equal texts, or part of a large one: its key, weight and dimensions."""
    sums = rows.groupBy("text_hash", "text_size").agg(F.sum("size").alias("weight"), F.count("*").alias("n"), F.min("lang").alias("lang"), F.min("source").alias("source"))
    # parts of the size of a large group's share, at most one a row
    parts = F.greatest(F.lit(1), F.least(F.col("n"), F.ceil(F.col("weight") / F.lit(max(1.0, whole * target)))))
    return sums.withColumn("parts", parts.cast("long"))


def _prefix(a: bytes, b: bytes) -> int:
    return next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


def _dimension_key(points: DataFrame) -> DataFrame:
    """Dimensions as integers of 16 bits: the length's logarithm, and a name's place between the least and the greatest by its NAME_BYTES bytes after what all names
    begin with."""
    ends = points.agg(*(f(c).alias(f"{n}_{c}") for c in ("lang", "source") for n, f in (("lo", F.min), ("hi", F.max)))).first()

    def place(c: str) -> Column:
        lo, hi = ((ends[f"{n}_{c}"] or "").encode() for n in ("lo", "hi"))
        at = _prefix(lo, hi)
        number = lambda raw: int.from_bytes(raw[at : at + NAME_BYTES].ljust(NAME_BYTES, b"\0"), "big")
        here = F.conv(F.rpad(F.hex(F.substring(F.col(c).cast("binary"), at + 1, NAME_BYTES)), 2 * NAME_BYTES, "0"), 16, 10).cast("long")
        return F.floor((here - number(lo)) / F.lit(float(max(1, number(hi) - number(lo)))) * 65535).cast("long")

    return points.withColumns({"length": F.floor(F.log2(F.col("text_size") + 1.0) / 40 * 65535).cast("long"), "lang": place("lang"), "source": place("source")})


def _order(dim: Column, mixed: Column) -> Column:
    return F.shiftleft(dim.cast("long"), KEY_BITS - 16).bitwiseOR(F.shiftrightunsigned(mixed, 64 - KEY_BITS + 16))


def k_d_tree(points: DataFrame, shards: int) -> list[dict]:
    """Splits of the tree, from the root: node, its dimension, the key from which points go right, and the children.

    points: weight, mixed (a hash), and the dimensions. A node of k shards gives its left child k // 2 of them, and the weight in
    proportion."""
    total = points.agg(F.sum("weight").alias("w"), *(f(d).alias(f"{n}_{d}") for d in DIMENSIONS for n, f in (("lo", F.min), ("hi", F.max)))).first()
    splits: list[dict] = []
    if not total["w"]:
        return splits
    width = {d: max(1, total[f"hi_{d}"] - total[f"lo_{d}"]) for d in DIMENSIONS}
    nodes, fresh = {0: shards}, 1
    while any(k > 1 for k in nodes.values()):
        at = assigned(points, splits)
        of = {r["node"]: r for r in at.where(F.col("node").isin([n for n, k in nodes.items() if k > 1])).groupBy("node").agg(F.sum("weight").alias("w"), F.count("*").alias("n"), *(f(d).alias(f"{n}_{d}") for d in DIMENSIONS for n, f in (("lo", F.min), ("hi", F.max)))).collect()}
        level = []
        for n, k in sorted(nodes.items()):
            if k > 1:
                r = of.get(n)
                dim = max(DIMENSIONS, key=lambda d: (r[f"hi_{d}"] - r[f"lo_{d}"]) / width[d]) if r else DIMENSIONS[0]
                level.append({"node": n, "dim": dim, "want": (r["w"] if r else 0) * (k // 2) / k, "left": fresh, "right": fresh + 1, "from": 0, "below": 0.0, "before": 0, "n": r["n"] if r else 0, "shards": k})
                fresh += 2
        key = F.lit(None).cast("long")
        for s in level:
            key = F.when(F.col("node") == s["node"], _order(F.col(s["dim"]), F.col("mixed"))).otherwise(key)
        keyed = at.select("node", "weight", key.alias("key")).where("key IS NOT NULL")
        for shift in range(KEY_BITS - DIGIT_BITS, -1, -DIGIT_BITS):
            inside = F.lit(False)
            for s in level:
                inside = F.when(F.col("node") == s["node"], F.shiftright("key", shift + DIGIT_BITS) == (s["from"] >> (shift + DIGIT_BITS))).otherwise(inside)
            counts: dict[int, list[tuple[int, int, int]]] = {}
            for r in keyed.where(inside).groupBy("node", F.shiftright("key", shift).bitwiseAND(DIGIT - 1).alias("digit")).agg(F.sum("weight").alias("w"), F.count("*").alias("n")).orderBy("node", "digit").collect():
                counts.setdefault(r["node"], []).append((r["digit"], r["w"], r["n"]))
            for s in level:
                # the digit in which the wanted weight is passed; on the last digit, the nearer of its two ends
                for digit, w, n in counts.get(s["node"], []):
                    here = s["from"] + (digit << shift)
                    if s["below"] + w > s["want"]:
                        after = not shift and s["want"] - s["below"] > s["below"] + w - s["want"]
                        s["cut"] = here + after
                        s["before"] += n * after
                        s["next"] = here
                        break
                    s["below"] += w
                    s["before"] += n
                    s["cut"] = s["next"] = here + (1 << shift)
                s["from"] = s.pop("next", s["from"])
        splits += [{"node": s["node"], "dim": s["dim"], "cut": s.get("cut", 0), "left": s["left"], "right": s["right"]} for s in level]
        # a side of few points, such as one long text, takes no more shards than points, and the other side the rest
        nodes = {n: k for n, k in nodes.items() if k == 1}
        for s in level:
            k = s["shards"]
            left = max(1, min(k // 2, s["before"])) if s["before"] <= k // 2 else k - max(1, min(k - k // 2, s["n"] - s["before"]))
            nodes |= {s["left"]: left, s["right"]: k - left}
    return splits


def assigned(points: DataFrame, splits: list[dict]) -> DataFrame:
    """The points with the node that each has come to."""
    by_node = {s["node"]: s for s in splits}

    def at(node: int) -> Column:
        if node not in by_node:
            return F.lit(node)
        s = by_node[node]
        return F.when(_order(F.col(s["dim"]), F.col("mixed")) < F.lit(s["cut"]), at(s["left"])).otherwise(at(s["right"]))

    return points.withColumn("node", at(0).cast("int"))


def shard(df: DataFrame, scratch: Scratch, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", whole: float = WHOLE) -> DataFrame:
    """(id, size, text_crc32, shard, slot) with shard sizes as equal as whole groups allow."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    raw = text.cast("binary")
    rows = scratch.cut(
        df.select(
            F.col(id_col).alias("id"), (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(raw).alias("text_crc32"), F.octet_length(text).cast("long").alias("text_size"), F.xxhash64(raw).alias("text_hash"),
            F.coalesce(F.col(lang_col), F.lit("")).alias("lang"), F.coalesce(F.col(source_col), F.lit("")).alias("source"),
        )
    )
    total = rows.agg(F.sum("size")).first()[0] or 0
    groups = scratch.cut(_groups(rows, total // shards, whole))
    # a large group's parts take its rows by a hash of the id; each part's weight is the sum of its own rows
    large = groups.where("parts > 1").select("text_hash", "text_size", "parts", F.col("lang").alias("l"), F.col("source").alias("s"))
    # at most shards / whole groups can be over that part of a leaf, so this side has a proven bound
    parted = rows.join(F.broadcast(large), ["text_hash", "text_size"]).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
    large_points = parted.groupBy("text_hash", "text_size", "part").agg(F.sum("size").alias("weight"), F.min("l").alias("lang"), F.min("s").alias("source"))
    points = groups.where("parts = 1").select("text_hash", "text_size", F.lit(0).cast("long").alias("part"), "weight", "lang", "source").unionByName(large_points)
    points = scratch.cut(_dimension_key(points).withColumn("mixed", F.xxhash64("text_hash", "text_size", "part")))
    splits = k_d_tree(points, shards)
    inner = {s["node"] for s in splits}
    leaves = sorted({0, *(s[side] for s in splits for side in ("left", "right"))} - inner)
    number = F.lit(0)
    for i, leaf in enumerate(leaves):
        number = F.when(F.col("node") == leaf, i).otherwise(number)
    placed = assigned(points, splits).select("text_hash", "text_size", "part", number.cast("int").alias("shard"))
    keyed = rows.join(F.broadcast(large.select("text_hash", "text_size", "parts")), ["text_hash", "text_size"], "left").withColumn("part", F.coalesce(F.pmod(F.xxhash64("id"), F.col("parts")), F.lit(0)))
    out = scratch.cut(keyed.join(placed, ["text_hash", "text_size", "part"]).select("id", "size", "text_crc32", "shard"))
    return slots(out, rows.count()).select(F.col("id").alias(id_col), "size", "text_crc32", "shard", "slot")


def slots(out: DataFrame, n: int, run: int = RUN) -> DataFrame:
    """Adds slot, from 0 without gaps in each shard: rows are numbered within short runs by a hash of the id, and runs get
    their start from the counts of those before."""
    runs = max(1, -(-n // run))
    keyed = out.withColumn("_run", F.pmod(F.xxhash64("id", F.lit(3)), F.lit(runs)).cast("int"))
    counts = keyed.groupBy("shard", "_run").agg(F.count("*").alias("_n"))
    starts = counts.withColumn("_start", F.coalesce(F.sum("_n").over(Window.partitionBy("shard").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    numbered = keyed.withColumn("_place", F.row_number().over(Window.partitionBy("shard", "_run").orderBy("id", "text_crc32", "size")) - 1)
    return numbered.join(starts, ["shard", "_run"]).withColumn("slot", (F.col("_start") + F.col("_place")).cast("long")).drop("_run", "_start", "_place")
