"""Removal of repeated byte strings: every byte covered by a string of ``LENGTH`` bytes that also starts earlier goes.

A string start is a later copy where its longest previous factor (the longest prefix that also starts at a smaller position) has LENGTH bytes or
more. Factors come from suffix order: strings are dealt into ranges by sampled splitters, sorted, and previous and next smaller positions give each
its factor. Ranges end between different strings, so that no factor of LENGTH bytes crosses a border.

Sorting every suffix of a corpus would move each byte LENGTH times. Three exact steps leave out what cannot be, or already is, a copy:

1. Each start is represented by the smallest hash among its string's GRAM-byte pieces (leftmost where equal), which equal strings share. Neighbouring
   starts with one piece form a *context*, a row without text. Contexts whose piece occurs once go.
2. Of equal contexts (by a hash of their bytes, within one piece) the first stays and the others are later copies whole; a piece that is left with one
   context goes. This is aggregated before the shuffle, so that a group of copies of any size costs rows, not a task.
3. The contexts left are cut into aligned blocks of BLOCK starts. Blocks whose common bytes occur once go, and of equal blocks the first stays.

What is left of the texts is read then, string by string. Each task first finds factors among its own strings and sends on only those
without one, so that a string that a third of all documents hold is a row for each CHUNK, not for each document.

Every text takes this one way, whatever the sizes. Texts are UTF-8 bytes, null counts as empty; matches don't cross documents; shorter texts than
LENGTH lose nothing. Rows that repeat an id with its text get the same result. A row without an id, or whose id has several different texts, has no place in
the order: it loses nothing and takes nothing. Empty tables give no rows. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, bound_batches, map_batches, mix

LENGTH = 100
#: A multiple of 8.
GRAM = 24
#: Starts of a block.
BLOCK = 4
#: Bytes of text that are hashed at a time (few enough for a core's own cache), and strings that a task puts in order at a time.
BUFFER, CHUNK = 1 << 16, 1 << 17
_C = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def piece_hashes(buffer: bytes) -> np.ndarray:
    """A hash of the GRAM bytes at each position (zeros after the end)."""
    n = len(buffer)
    padded = buffer + bytes(GRAM + 8)
    words = np.empty(n + GRAM, np.uint64)
    for o in range(8):
        got = words[o::8]
        got[:] = np.frombuffer(padded, "<u8", len(got), o)
    h = words[:n] * _C[0]
    for k in range(8, GRAM, 8):
        w = words[k : n + k]
        h = (h ^ (h >> np.uint64(31))) * _C[1] + (w ^ (w >> np.uint64(29))) * _C[2]
    return mix(h)


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2**64."""
    base, out = 0x9E3779B97F4A7C15, []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.full(n, b, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


class Ranges:
    """Hashes of byte ranges of a buffer, from sums of its pieces' hashes times powers by position; ranges have at least GRAM bytes."""

    def __init__(self, h: np.ndarray):
        size = 1 << max(17, int(len(h)).bit_length())
        power, self.inverse = _powers(size)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * power[: len(h)], dtype=np.uint64)])

    def of(self, start: np.ndarray, stop: np.ndarray, salt: np.ndarray) -> np.ndarray:
        whole = (self.sums[stop - GRAM + 1] - self.sums[start]) * self.inverse[start]
        return mix(mix(whole + (stop - start).astype(np.uint64) * _C[2]) + salt.astype(np.uint64) * _C[0]).view(np.int64)


def leftmost_minimum(h: np.ndarray, wide: int) -> np.ndarray:
    """For each position, where the smallest of the next ``wide`` values is, the leftmost if several are.

    The position takes the place of a value's lowest bits, so that one minimum gives both; values that differ in those bits only count as equal, in equal strings alike."""
    low = np.uint64((1 << max(0, len(h) - 1).bit_length()) - 1)
    value, size = (h & ~low) | np.arange(len(h), dtype=np.uint64), 1
    while size < wide:
        step = min(size, wide - size)
        value = np.minimum(value[step:], value[:-step])
        size += step
    return (value & low).view(np.int64)


def contexts(texts: list[bytes], only_pieces: bool = False) -> tuple[np.ndarray, ...]:
    """(text, hash, bytes, start, starts, offset) of the contexts: hashes of the piece and of all bytes, the first start, the number of starts, the piece's offset from the first start.
    only_pieces: their hashes alone."""
    out: list[tuple[np.ndarray, ...]] = []
    wide, at = LENGTH - GRAM + 1, 0
    # a long text is hashed in segments that overlap so far that every start is in one of them
    segments = [(i, b) for i, x in enumerate(texts) for b in range(0, max(1, len(x) - LENGTH + 1), BUFFER)]
    of, base = np.array([i for i, _ in segments], np.int64), np.array([b for _, b in segments], np.int64)
    texts = [texts[i] if len(texts[i]) <= BUFFER else texts[i][b : b + BUFFER + LENGTH - 1] for i, b in segments]
    while at < len(texts):
        upto, size = at, 0
        while upto < len(texts) and (upto == at or size + len(texts[upto]) <= BUFFER):
            size += len(texts[upto])
            upto += 1
        lengths = np.array([len(x) for x in texts[at:upto]])
        ends = np.cumsum(lengths)
        first, count = ends - lengths, np.maximum(0, lengths - LENGTH + 1)
        if count.sum():
            h = piece_hashes(b"".join(texts[at:upto]))
            text = np.repeat(np.arange(len(lengths)), count)
            start = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
            piece = leftmost_minimum(h, wide)[start]
            new = np.flatnonzero(np.r_[True, (np.diff(piece) != 0) | (np.diff(text) != 0)])
            if only_pieces:
                out.append((h[piece[new]].view(np.int64),))
                at = upto
                continue
            t, a, n = text[new], start[new], np.diff(np.r_[new, len(start)])
            offset = piece[new] - a
            out.append((of[t + at], h[piece[new]].view(np.int64), Ranges(h).of(a, a + n + LENGTH - 1, offset), a - first[t] + base[t + at], n, offset))
        at = upto
    width = 1 if only_pieces else 6
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(width))
    return tuple(np.concatenate([x[i] for x in out]).astype(np.int64, copy=False) for i in range(width))


def blocks(raw: bytes, first: np.ndarray, starts: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, ...]:
    """(context, core, whole, at, n) of the aligned blocks of up to BLOCK starts of contexts that stand one after the other in raw.

    A start's place is its distance from the piece, so equal strings are in blocks of one number. core hashes the bytes that every string of that number
    has, whole all bytes of the block's own strings; at is the block's first start in its context, n how many it has."""
    number = (np.repeat(offset, starts) - (np.arange(starts.sum()) - np.repeat(np.cumsum(starts) - starts, starts))) // BLOCK
    of = np.repeat(np.arange(len(starts)), starts)
    new = np.flatnonzero(np.r_[True, (np.diff(number) != 0) | (np.diff(of) != 0)])
    of, number, n = of[new], number[new], np.diff(np.r_[new, len(number)])
    at = new - (np.cumsum(starts) - starts)[of]
    last = offset[of] - number * BLOCK  # the last start of a whole block of that number
    ranges, base = Ranges(piece_hashes(raw)), first[of]
    core = ranges.of(base + last, base + last - BLOCK + 1 + LENGTH, number)
    whole = ranges.of(base + at, base + at + n + LENGTH - 1, offset[of] - at)
    return of, core, whole, at, n


def longest_previous_factor(position: list[int], lcp: list[int]) -> list[int]:
    """By rank: the longest common prefix with any suffix at a smaller position. position: of each rank; lcp[r]: with rank r - 1.

    One pass keeps a stack of ranks with rising positions: what stands below a rank is its previous smaller position, what removes it is
    its next smaller one."""
    out, stack = [0] * len(position), []  # of (rank, common prefix with the one below)
    for r, p in enumerate(position):
        common = lcp[r] if r else 0
        while stack and position[stack[-1][0]] > p:
            top, with_below = stack.pop()
            out[top] = max(with_below, common)
            common = min(common, with_below)
        stack.append((r, common if stack else 0))
    for r, with_below in stack:
        out[r] = max(out[r], with_below)
    return out


def later_copies(strings: np.ndarray, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Which of the strings, rows of LENGTH bytes in suffix order (equal ones by id and start), have a longest previous factor of LENGTH bytes."""
    flags = np.zeros(len(strings), bool)
    if len(strings) < 2:
        return flags
    same = strings[1:] == strings[:-1]
    lcp = np.r_[0, np.where(same.all(1), LENGTH, same.argmin(1))]
    # only ranks next to an equal string can have a factor of that length
    equal = lcp >= LENGTH
    some = np.flatnonzero(equal | np.r_[equal[1:], False])
    position = np.empty(len(some), np.int64)
    position[np.lexsort((starts[some], ids[some]))] = np.arange(len(some))
    factor = longest_previous_factor(position.tolist(), lcp[some].tolist())
    flags[some] = np.array(factor, np.int64) >= LENGTH
    return flags


def _light(docs: DataFrame) -> DataFrame:
    """(hash, bytes, id, packed) of every context; packed holds its start, number of starts and the piece's offset."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        text, h, whole, start, count, offset = contexts(batch.column(1).to_pylist())
        return pa.record_batch([pa.array(h), pa.array(whole), batch.column(0).take(pa.array(text)), pa.array(start << 16 | count << 8 | offset)], names=["hash", "bytes", "id", "packed"])

    return map_batches(docs.select("id", "raw"), run, "hash long, bytes long, id long, packed long")


def _pieces(docs: DataFrame) -> DataFrame:
    """(hash) of every context."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.record_batch([pa.array(contexts(batch.column(0).to_pylist(), True)[0])], names=["hash"])

    return map_batches(docs.select("raw"), run, "hash long")


def _read(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, packed, context) with the bytes of the wanted contexts. What is gathered for an id is bounded by its text."""
    lists = wanted.groupBy("id").agg(F.collect_list("packed").alias("at"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, packed, parts = [], [], []
        for i, raw, at in zip(batch.column("id").to_pylist(), batch.column("raw"), batch.column("at").to_pylist(), strict=True):
            raw = raw.as_py()
            ids += [i] * len(at)
            packed += at
            parts += [raw[p >> 16 : (p >> 16) + (p >> 8 & 255) + LENGTH - 1] for p in at]
        return pa.record_batch([pa.array(ids, pa.int64()), pa.array(packed, pa.int64()), pa.array(parts, pa.binary())], names=["id", "packed", "context"])

    return map_batches(docs.select("id", "raw").join(lists, "id"), run, "id long, packed long, context binary")


def _blocks(texts: DataFrame) -> DataFrame:
    """(core, whole, id, place) of the contexts' blocks; place holds packed, the block's first start in the context and its number of starts."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, packed, parts = batch.column("id").to_numpy(), batch.column("packed").to_numpy(), batch.column("context").to_pylist()
        lengths = np.array([len(x) for x in parts])
        of, core, whole, at, n = blocks(b"".join(parts), np.cumsum(lengths) - lengths, packed >> 8 & 255, packed & 255)
        return pa.record_batch([pa.array(core), pa.array(whole), pa.array(ids[of]), pa.array(packed[of] << 16 | at << 8 | n)], names=["core", "whole", "id", "place"])

    return map_batches(texts.select("id", "packed", "context"), run, "core long, whole long, id long, place long")


def _ordered(strings: np.ndarray, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(strings), -(-LENGTH // 8) * 8), np.uint8)
    wide[:, :LENGTH] = strings
    return np.lexsort((starts, ids, *wide.view(">u8").T[::-1]))


def _distinct(ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Which rows, in order, are of another place than the row before: rows of a document that is there twice are one."""
    return np.r_[True, (np.diff(ids) != 0) | (np.diff(starts) != 0)] if len(ids) else np.zeros(0, bool)


def _strings(texts: DataFrame, left: DataFrame) -> DataFrame:
    """(string, id, start, stop) of the starts of the blocks that are left: a string with its start, or without one a run of starts that are later copies among the task's own."""
    lists = left.select("id", F.shiftright("place", 16).alias("packed"), "place").groupBy("id", "packed").agg(F.collect_list("place").alias("places"))
    names = ["string", "id", "start", "stop"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def found() -> Iterator[pa.RecordBatch]:
            strings, ids, starts = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            order = _ordered(strings, ids, starts)
            strings, ids, starts = strings[order], ids[order], starts[order]
            once = _distinct(ids, starts)
            strings, ids, starts = strings[once], ids[once], starts[once]
            later = later_copies(strings, ids, starts)
            n = int((~later).sum())
            flat = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((np.arange(n + 1) * LENGTH).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(strings[~later]))])
            yield pa.record_batch([flat, pa.array(ids[~later]), pa.array(starts[~later]), pa.array(starts[~later] + 1)], names=names)
            order = np.lexsort((starts[later], ids[later]))
            i, s = ids[later][order], starts[later][order]
            new = np.flatnonzero(np.r_[True, (np.diff(i) != 0) | (np.diff(s) != 1)]) if len(i) else np.zeros(0, int)
            yield pa.record_batch([pa.nulls(len(new), pa.binary()), pa.array(i[new]), pa.array(s[new]), pa.array(s[np.r_[new[1:] - 1, len(s) - 1]] + 1 if len(new) else s)], names=names)

        count = 0
        for batch in batches:
            for i, packed, raw, places in zip(*(batch.column(c).to_pylist() for c in ("id", "packed", "context", "places")), strict=True):
                at = np.concatenate([np.arange(p >> 8 & 255, (p >> 8 & 255) + (p & 255)) for p in set(places)])
                held.append((np.lib.stride_tricks.sliding_window_view(np.frombuffer(raw, np.uint8), LENGTH)[at], np.full(len(at), i), (packed >> 16) + at))
                count += len(at)
                if count >= CHUNK:
                    yield from found()
                    count = 0
        if held:
            yield from found()

    both = texts.join(lists, ["id", "packed"]).select("id", "packed", "context", "places")
    bound_batches(texts.sparkSession)
    return both.mapInArrow(run, "string binary, id long, start long, stop long")


def _factors(ranges: DataFrame) -> DataFrame:
    """(id, from, to) of the later copies; ranges must be in order of string, id and start, equal strings in one partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: tuple[np.ndarray, ...] = (np.zeros((0, LENGTH), np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64))
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column("string")
            offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + 1]
            raw = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[0] + LENGTH * batch.num_rows]
            mine = (raw.reshape(-1, LENGTH), batch.column("id").to_numpy(), batch.column("start").to_numpy())
            # the row before stands for all earlier ones: of equal strings each rank's previous smaller position is the rank before
            strings, ids, starts = (np.concatenate(x) for x in zip(before, mine, strict=True))
            flags = later_copies(strings, ids, starts) & _distinct(ids, starts)
            flags[: len(before[0])] = False
            yield pa.record_batch([pa.array(ids[flags]), pa.array(starts[flags]), pa.array(starts[flags] + 1)], names=["id", "from", "to"])
            before = (strings[-1:].copy(), ids[-1:], starts[-1:])

    bound_batches(ranges.sparkSession)
    return ranges.select("string", "id", "start").mapInArrow(run, "id long, `from` long, `to` long")


def repeats(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, from, to): string starts, from to before to, that are later copies. docs: id, raw; an id has one text."""
    often = _pieces(docs).groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash")
    every = scratch.cut(_light(docs).join(often, "hash", "left_semi"))
    first = F.min(F.struct("id", "packed")).alias("first")
    firsts = scratch.cut(every.groupBy("hash", "bytes").agg(first, F.count("*").alias("n")).select("hash", "bytes", F.col("first.id").alias("f_id"), F.col("first.packed").alias("f_packed"), "n"))
    start = F.shiftright("packed", 16)
    copies = every.join(firsts.where("n > 1"), ["hash", "bytes"]).where("id <> f_id OR packed <> f_packed").select("id", start.alias("from"), (start + F.shiftright("packed", 8).bitwiseAND(255)).alias("to"))
    found = [scratch.cut(copies)]
    scratch.drop(every)
    several = firsts.groupBy("hash").agg(F.count("*").alias("g")).where("g > 1").select("hash")
    wanted = firsts.join(several, "hash", "left_semi").select(F.col("f_id").alias("id"), F.col("f_packed").alias("packed"))
    texts = scratch.cut(_read(docs, wanted))
    scratch.drop(firsts)
    cut = _blocks(texts)
    common = cut.groupBy("core").agg(F.count("*").alias("n")).where("n > 1").select("core")
    near = scratch.cut(cut.join(common, "core", "left_semi"))
    first = F.min(F.struct("id", "place")).alias("first")
    firsts = scratch.cut(near.groupBy("core", "whole").agg(first, F.count("*").alias("n")).select("core", "whole", F.col("first.id").alias("f_id"), F.col("first.place").alias("f_place"), "n"))
    start = F.shiftright("place", 32) + F.shiftright("place", 8).bitwiseAND(255)
    equal = near.join(firsts.where("n > 1"), ["core", "whole"]).where("id <> f_id OR place <> f_place").select("id", start.alias("from"), (start + F.col("place").bitwiseAND(255)).alias("to"))
    found.append(scratch.cut(equal))
    scratch.drop(near)
    several = firsts.groupBy("core").agg(F.count("*").alias("g")).where("g > 1").select("core")
    left = firsts.join(several, "core", "left_semi").select(F.col("f_id").alias("id"), F.col("f_place").alias("place"))
    strings = scratch.cut(_strings(texts, left))
    scratch.drop(texts, firsts)
    found.append(strings.where("string IS NULL").select("id", F.col("start").alias("from"), F.col("stop").alias("to")))
    found.append(scratch.cut(_factors(strings.where("string IS NOT NULL").repartitionByRange("string").sortWithinPartitions("string", "id", "start"))))
    return found[0].unionByName(found[1]).unionByName(found[2]).unionByName(found[3])


def _kept(raw: bytes, runs: list[dict]) -> tuple[bytes, list[tuple[int, int]]]:
    spans: list[list[int]] = []
    for r in sorted((r["from"], r["to"]) for r in runs):
        a, b = r[0], r[1] - 1 + LENGTH
        if spans and a <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], b)
        else:
            spans.append([a, b])
    out, at = [], 0
    for a, b in spans:
        out.append(raw[at:a])
        at = b
    return b"".join([*out, raw[at:]]), [(a, b) for a, b in spans]


def whole_characters(raw: bytes, spans: list[tuple[int, int]]) -> str:
    """The text without the spans, each drawn in to whole characters: one of which any byte stays, stays."""
    out, at = [], 0
    for a, b in spans:
        while a < b and raw[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(raw) and raw[b] & 0xC0 == 0x80:
            b -= 1
        out.append(raw[at:a])
        at = max(at, b)
    return b"".join([*out, raw[at:]]).decode()


def dedup(df: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, kept, spans) of every row, with the columns in keep. kept is the text that
    is left, spans drawn in to whole characters; the counts and the checksum are of bytes."""
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    docs = df.select(F.col(id_col).cast("long").alias("id"), raw.alias("raw"), *(F.col(c).alias(f"keep_{c}") for c in keep))
    placed = docs.select("id", "raw").where("id IS NOT NULL")
    texts = placed.select("id", F.xxhash64("raw").alias("h"), F.octet_length("raw").alias("n"))
    several = scratch.cut(texts.groupBy("id").agg(F.min(F.struct("h", "n")).alias("lo"), F.max(F.struct("h", "n")).alias("hi")).where("lo <> hi").select("id"))
    if not several.isEmpty():
        placed = placed.join(several, "id", "left_anti")
    runs = repeats(placed.where(F.octet_length("raw") >= LENGTH), scratch).groupBy("id").agg(F.collect_list(F.struct("from", "to")).alias("runs"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns: list[list] = [[], [], [], [], [], []]
        for raw, runs in zip(batch.column("raw").to_pylist(), batch.column("runs").to_pylist(), strict=True):
            kept, spans = _kept(raw, runs or [])
            for c, v in zip(columns, (len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), whole_characters(raw, spans), [{"start": a, "stop": b} for a, b in spans]), strict=True):
                c.append(v)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))]
        return pa.record_batch([batch.column("id"), *(batch.column(f"keep_{c}") for c in keep), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=[id_col, *keep, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans"])

    kinds = "".join(f", `{c}` {df.schema[c].dataType.simpleString()}" for c in keep)
    return map_batches(docs.join(runs, "id", "left"), run, f"`{id_col}` long{kinds}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string, spans array<struct<start:long,stop:long>>")
