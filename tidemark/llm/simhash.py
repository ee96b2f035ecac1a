"""SimHash fingerprints of 128 bits and the search of all within a Hamming radius, in DataFrame operations only.

A term is a pair of neighbouring words (the last word also by itself); each occurrence counts, so a term's weight is its frequency. Words of over PIECE characters, such as texts
without spaces, count as several. Two 64-bit hashes of the term vote on the bits; a bit is set where more than half of the weight votes for it. Votes are summed two to a
long, 32 bits each: texts of up to 2**32 terms have exact votes.

Search: query fingerprints against all. Bits fall into so many blocks that two fingerprints within the radius differ in at most two bits of at least one. One
table for each block holds every fingerprint by the block's bits; a query looks up its own bits with none, one and two of them flipped. Candidates are checked in full, so that no
pair is missed, and each pair is reported by its first such block. Equal fingerprints are searched once, with their number. One changed word alters two terms of n: their cosine is
1 - 2 / n, and about 8 bits differ at 100 words.

Null text counts as empty. Equal texts have equal fingerprints. Every row is returned: rows without an id stand before all others in the order of ids, rows of one id are ordered by
their text's hash, and rows equal in both are one document and get the same result. Empty tables give no rows. Further columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch

BITS = 128
#: Four blocks of 32 bits. By a binomial estimate 0.88 of copies with one changed word of 100 are within, 0.99 of 200.
RADIUS = 11
HALF = (1 << 32) - 1
PIECE = 8
#: Rows whose id this divides are the search's queries.
QUERIES = 100
#: The place of rows without an id.
NO_ID = -(1 << 63)


def fingerprints(df: DataFrame, keys: list[str], text_col: str) -> DataFrame:
    """(keys, high, low) of each text; keys must name rows uniquely. Rows stay where they are if already dealt by a key."""
    found = F.regexp_extract_all(text_col, F.lit(rf"(\S{{1,{PIECE}}})"), 1)
    words = df.select(*keys, found.alias("w")).withColumn("w", F.when(F.size("w") == 0, F.array(F.lit(""))).otherwise(F.col("w")))
    each = words.select(*keys, F.explode(F.arrays_zip("w", F.slice("w", 2, F.size("w")).alias("x"))).alias("t"))
    hashed = each.select(*keys, F.xxhash64(F.lit(1), F.col("t")["w"], F.col("t")["x"]).alias("h0"), F.xxhash64(F.lit(2), F.col("t")["w"], F.col("t")["x"]).alias("h1"))
    two = F.lit((1 << 32) | 1)
    votes = hashed.groupBy(*keys).agg(F.count("*").alias("n"), *(F.sum(F.shiftrightunsigned(h, j).bitwiseAND(two)).alias(f"{h}_{j}") for h in ("h0", "h1") for j in range(32)))

    def bits(h: str) -> Column:
        out = F.lit(0).cast("long")
        for j in range(32):
            s = F.col(f"{h}_{j}")
            low, high = s.bitwiseAND(F.lit(HALF)) * 2 > F.col("n"), F.shiftrightunsigned(s, 32) * 2 > F.col("n")
            out = out.bitwiseOR(F.when(low, F.lit(1 << j)).otherwise(F.lit(0).cast("long"))).bitwiseOR(F.when(high, F.shiftleft(F.lit(1).cast("long"), j + 32)).otherwise(F.lit(0).cast("long")))
        return out

    return votes.select(*keys, bits("h0").alias("high"), bits("h1").alias("low"))


def as_text(high: Column, low: Column) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(high), 16, "0"), F.lpad(F.hex(low), 16, "0")))


def distance(a_high: Column, a_low: Column, b_high: Column, b_low: Column) -> Column:
    return F.bit_count(a_high.bitwiseXOR(b_high)) + F.bit_count(a_low.bitwiseXOR(b_low))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def near_fingerprints(queries: DataFrame, prints: DataFrame, scratch: Scratch, radius: int = RADIUS) -> DataFrame:
    """(a_high, a_low, b_high, b_low, distance): each query fingerprint a with every different fingerprint b of prints within the radius, once."""
    n, at, blocks = max(radius // 3 + 1, min(radius + 1, 2)), 0, []
    flips = radius // n
    for k in range(n):
        wide = BITS // n + (k < BITS % n)
        # (column, first bit, number of bits) of the one or two longs that the block lies in
        blocks.append([(name, max(at, start) - start, min(at + wide, start + 64) - max(at, start)) for name, start in (("low", 0), ("high", 64)) if max(at, start) < min(at + wide, start + 64)])
        at += wide
    zero = F.lit(0).cast("long")
    values = lambda block, p="": [F.shiftrightunsigned(p + c, first).bitwiseAND(F.lit(_signed((1 << bits) - 1)).cast("long")) for c, first, bits in block]
    single, asked = scratch.cut(prints.select("high", "low").distinct()), scratch.cut(queries.select("high", "low").distinct())
    found, earlier = [], F.lit(False)
    for block in blocks:
        w, wide = block[0][2], sum(x[2] for x in block)
        masks = [sum(1 << b for b in bits) for r in range(flips + 1) for bits in combinations(range(wide), r)]
        flipped = F.array(*(F.struct(F.lit(_signed(m & (1 << w) - 1)).cast("long").alias("u"), F.lit(_signed(m >> w)).cast("long").alias("v")) for m in masks))
        u, v = [*values(block), zero][:2]
        looked = asked.select(F.col("high").alias("a_high"), F.col("low").alias("a_low"), u.alias("u"), v.alias("v"), F.explode(flipped).alias("m"))
        looked = looked.select("a_high", "a_low", F.col("u").bitwiseXOR(F.col("m.u")).alias("u"), F.col("v").bitwiseXOR(F.col("m.v")).alias("v"))
        table = single.select(F.col("high").alias("b_high"), F.col("low").alias("b_low"), u.alias("u"), v.alias("v"))
        away = distance(F.col("a_high"), F.col("a_low"), F.col("b_high"), F.col("b_low"))
        # Spark takes the exploded side for as small as its source and would broadcast it
        found.append(scratch.cut(looked.hint("merge").join(table, ["u", "v"]).where(away.between(1, radius) & ~earlier).select("a_high", "a_low", "b_high", "b_low", away.alias("distance"))))
        apart = sum((F.bit_count(x.bitwiseXOR(y)) for x, y in zip(values(block, "a_"), values(block, "b_"), strict=True)), F.lit(0))
        earlier = earlier | (apart <= flips)
    scratch.drop(single, asked)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def near_counts(prints: DataFrame, scratch: Scratch, radius: int = RADIUS) -> DataFrame:
    """(high, low, n_near) of the fingerprints of rows where ``query`` holds: how many other rows have a fingerprint within the radius, equal ones included."""
    sizes = scratch.cut(prints.groupBy("high", "low").agg(F.count("*").alias("n"), F.max("query").alias("query")))
    pairs = near_fingerprints(sizes.where("query"), sizes, scratch, radius)
    other = sizes.select(F.col("high").alias("b_high"), F.col("low").alias("b_low"), F.col("n").alias("m"))
    more = pairs.join(other, ["b_high", "b_low"]).groupBy(F.col("a_high").alias("high"), F.col("a_low").alias("low")).agg(F.sum("m").alias("more"))
    return sizes.where("query").join(more, ["high", "low"], "left").select("high", "low", (F.col("n") - 1 + F.coalesce("more", F.lit(0))).alias("n_near"))


def following(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """rows (id, tie, n) with prior: the n of the row before in the order of (id, tie); the first gets the last one's.
    And with place of the row before: prior_id, prior_tie.

    The order is dealt into ranges; rows are followed up within each, and the ranges' ends through one row for each."""
    ranged = scratch.cut(rows.repartitionByRange("id", "tie").withColumn("range", F.spark_partition_id()))
    order = Window.partitionBy("range").orderBy("id", "tie")
    me = F.struct("id", "tie", "n")
    inner = ranged.withColumn("before", F.lag(me).over(order))
    # one row for each range: as many as there are shuffle partitions
    ends = ranged.groupBy("range").agg(F.max(me).alias("last"))
    line = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carried = ends.withColumn("back", F.coalesce(F.lag("last").over(Window.orderBy("range")), F.last("last").over(line))).select("range", "back")
    whole = inner.join(F.broadcast(carried), "range").withColumn("before", F.coalesce("before", "back"))
    return whole.select("id", "tie", F.col("before.id").alias("prior_id"), F.col("before.tie").alias("prior_tie"), F.col("before.n").alias("prior_n"))


def compare_with_edits(df: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, queries: int = QUERIES) -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_near) of every row; n_near is null where ``queries`` doesn't divide the id.

    The edited text is the text with its last quarter of code points replaced by as many first ones of the next document's."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    every = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(text).alias("tie"), F.char_length(text).cast("long").alias("n"), text.alias("text"))
    order = scratch.cut(following(every.select("id", "tie", "n").distinct(), scratch))
    # one row of each document; each learns how many of its first characters the one before asks for, and sends them there
    docs = every.select("id", "tie", "text").dropDuplicates(["id", "tie"])
    asked = docs.join(order, ["id", "tie"])
    heads = asked.select(F.col("prior_id").alias("id"), F.col("prior_tie").alias("tie"), F.expr("substring(text, 1, cast(prior_n div 4 as int))").alias("head"))
    edited = F.concat(F.expr("substring(text, 1, char_length(text) - cast(char_length(text) div 4 as int))"), F.col("head"))
    both = docs.join(heads, ["id", "tie"]).select("id", "tie", F.char_length("text").cast("long").alias("n_chars"), F.sha2(edited.cast("binary"), 256).alias("edited_sha256"), "text", edited.alias("edited"))
    versions = both.select("id", "tie", "n_chars", "edited_sha256", F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("text").alias("text")), F.struct(F.lit(1).alias("kind"), F.col("edited").alias("text")))).alias("v"))
    found = fingerprints(versions.select("id", "tie", "n_chars", "edited_sha256", "v.kind", "v.text"), ["id", "tie", "n_chars", "edited_sha256", "kind"], "text")
    pick = lambda c, k: F.max(F.when(F.col("kind") == k, F.col(c)))
    prints = scratch.cut(found.groupBy("id", "tie", "n_chars", "edited_sha256").agg(pick("high", 0).alias("high"), pick("low", 0).alias("low"), pick("high", 1).alias("e_high"), pick("low", 1).alias("e_low")))
    after = order.join(prints.select("id", "tie", F.col("high").alias("n_high"), F.col("low").alias("n_low")), ["id", "tie"]).select(F.col("prior_id").alias("id"), F.col("prior_tie").alias("tie"), "n_high", "n_low")
    rows = scratch.cut(every.select("id", "tie"))
    query = (F.col("id") != NO_ID) & (F.pmod(F.col("id"), F.lit(queries)) == 0)
    counts = scratch.cut(near_counts(rows.join(prints, ["id", "tie"]).select("high", "low", query.alias("query")), scratch, radius))
    like = lambda a, b, c, d: 1 - distance(F.col(a), F.col(b), F.col(c), F.col(d)) / F.lit(float(BITS))
    return rows.join(prints.join(after, ["id", "tie"]), ["id", "tie"]).join(counts, ["high", "low"], "left").select(
        F.when(F.col("id") != NO_ID, F.col("id")).alias(id_col), "n_chars", "edited_sha256", as_text(F.col("high"), F.col("low")).alias("fingerprint"), as_text(F.col("e_high"), F.col("e_low")).alias("edited_fingerprint"),
        like("high", "low", "e_high", "e_low").alias("near_edited"), like("high", "low", "n_high", "n_low").alias("near_next"), F.when(query, F.col("n_near")).alias("n_near"),
    )
