"""Best-fit packing of token pieces into sequences of bounded length, by hierarchical residual packing.

Pieces are dealt by a hash, so that lengths mix whatever the table's order. Each task packs best-fit, longest first, ``group`` items at a time, and is done with bins that are
nearly full. Underfull bins go on as items: groups of them pack each other's leftovers again, round by round, with fan_in times fewer groups each but no more than ``group``
items in one, until one group has packed all that is left, or a round over several groups has merged nothing. Every underfull bin goes on, whatever their number; only (bin, fill) pairs travel
between rounds, and pieces join the final places once.

Ids are what the library gives for the text without further switches, so the special tokens' strings in a text are their ids.
Null text counts as empty; an empty text is a piece of the closing id alone. A text longer than the capacity is cut into
pieces of exactly the capacity and a remainder. An empty table gives no rows. Repeated rows are packed once each. Further columns are ignored; an id column named like another
column of the result is an error.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, map_batches

VOCABULARY = "word_bpe_49k.json"
CAPACITY = 4096
CLOSING_ID = 1
#: Bins with at most this much room are nearly full.
NEARLY_FULL = 8
FAN_IN = 16
#: Items that one task packs at a time.
GROUP = 200_000
#: Chunks of text whose ids a worker remembers.
REMEMBERED = 300_000
#: What the special tokens' strings begin with; chunks that hold it are encoded singly.
SPECIAL = b"<|"
SEPARATOR, SEPARATOR_ID = "<|endoftext|>", 49407
PLACES = ("piece", "start", "length", "ids_crc32", "sequence_id", "offset")


#: In UTF-8: letters of ASCII and Latin-1, which are one word whatever their case and which no normaliser composes, and runs of ASCII marks but apostrophes before and after them,
#: which are a word each.
MARKS = rb"""([!"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~]*)"""
WORD = re.compile(MARKS + rb"((?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+)" + MARKS)
WORD_END = "</w>"


@lru_cache(maxsize=2)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=4)
def plain_words(path: str, ascii_only: bool):
    """The same model for lower-case words between spaces, without the normalisers and the pattern, which leave such words as they are."""
    from tokenizers import Tokenizer, pre_tokenizers

    out, spaces = Tokenizer(tokenizer(path).model), pre_tokenizers.WhitespaceSplit()
    out.pre_tokenizer = spaces if ascii_only else pre_tokenizers.Sequence([spaces, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return out


@lru_cache(maxsize=2)
def word_ends(path: str) -> np.ndarray:
    """By id, whether the token ends a word."""
    tokens = tokenizer(path).get_vocab()
    out = np.zeros(max(tokens.values()) + 1, bool)
    out[[i for t, i in tokens.items() if t.endswith(WORD_END)]] = True
    return out


class Ids:
    """Ids of texts as little-endian bytes. No token of this vocabulary spans white space and no normaliser acts across it, so each chunk between ASCII
    white space is encoded by itself and remembered; chunks seen lately outlive a full memory."""

    def __init__(self, path: str):
        self.path, self.known, self.older = path, {}, {}

    def of(self, texts: list[str]) -> list[bytes]:
        chunks = [x.encode().split() for x in texts]
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        known, older, new = self.known, self.older, []
        for c in set().union(*chunks).difference(known):
            if c in older:
                known[c] = older[c]
            else:
                new.append(c)
        if new:
            bare = [c for c in new if c.isalpha()]  # of ASCII's letters alone
            found = [(c, m[1], m[2].lower(), m[3]) for c in new if not c.isalpha() and SPECIAL not in c and (m := WORD.fullmatch(c))]
            lower = [c.lower() for c in bare]
            wanted = {w for _, _, w, _ in found}.union(lower).difference(known)
            known.update([(w, older[w]) for w in wanted if w in older])
            known.update(self._words([w for w in wanted if w not in older]))
            known.update(zip(bare, map(known.__getitem__, lower), strict=True))
            marks = self._encoded(list({m for _, a, _, b in found for m in (a, b) if m})) | {b"": b""}
            known.update([(c, marks[a] + known[w] + marks[b]) for c, a, w, b in found])
            known.update(self._encoded([c for c in new if c not in known]))
        return [b"".join(map(known.__getitem__, row)) for row in chunks]

    def _words(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Words of such letters, ASCII's in lower case, many at a call; each ends with the only one of its tokens that ends a word."""
        out, ends = {}, word_ends(self.path)
        for ascii_only in (True, False):
            own = [w for w in words if w.isascii() == ascii_only]
            lists = [own[i : i + 1000] for i in range(0, len(own), 1000)]
            for part, e in zip(lists, plain_words(self.path, ascii_only).encode_batch_fast([b" ".join(x).decode().lower() for x in lists], add_special_tokens=False), strict=True):
                ids = np.array(e.ids, "<u4")
                raw, stops = ids.tobytes(), (4 * (np.flatnonzero(ends[ids]) + 1)).tolist()
                out.update((w, raw[a:b]) for w, a, b in zip(part, [0, *stops], stops, strict=False))
                if len(stops) != len(part):
                    raise ValueError("this vocabulary doesn't end each word with a token of its own kind")
        return out

    def _encoded(self, chunks: list[bytes]) -> dict[bytes, bytes]:
        """Many chunks at a call, parted by a special token, at which the tokenizer parts texts before anything else."""
        own = tokenizer(self.path)
        plain, out = [c for c in chunks if SPECIAL not in c], {}
        lists = [plain[i : i + 1000] for i in range(0, len(plain), 1000)]
        for part, e in zip(lists, own.encode_batch_fast([SEPARATOR.join(c.decode() for c in part) for part in lists], add_special_tokens=False), strict=True):
            ids = np.array(e.ids, "<u4")
            raw, ends = ids.tobytes(), [*(4 * np.flatnonzero(ids == SEPARATOR_ID)).tolist(), 4 * len(ids)]
            at = 0
            for c, end in zip(part, ends, strict=True):
                out[c] = raw[at:end]
                at = end + 4
        for c in chunks:
            if c not in out:
                out[c] = np.array(own.encode(c.decode(), add_special_tokens=False).ids, "<u4").tobytes()
        return out


@lru_cache(maxsize=1)
def ids(path: str) -> Ids:
    return Ids(path)


def pieces(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = "", capacity: int = CAPACITY) -> DataFrame:
    """(id, piece, start, length, ids_crc32) of every document's ids with the closing id."""
    path, closing = path or public_tokenizers.path(VOCABULARY), np.array([CLOSING_ID], "<u4").tobytes()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows: list[tuple[int, int, int, int, int]] = []
        texts = [x.as_py() or "" for x in batch.column(1)]
        for at in range(0, len(texts), 64):
            for i, raw in enumerate(ids(path).of(texts[at : at + 64])):
                raw = memoryview(raw + closing)
                rows += [(at + i, k, b // 4, len(part := raw[b : b + 4 * capacity]) // 4, zlib.crc32(part)) for k, b in enumerate(range(0, len(raw), 4 * capacity))]
        row, piece, start, length, crc = map(list, zip(*rows, strict=True))
        return pa.record_batch([batch.column(0).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())], names=[id_col, "piece", "start", "length", "ids_crc32"])

    kind = df.schema[id_col].dataType.simpleString()
    return map_batches(df.select(id_col, text_col), run, f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long")


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, and the fill of each bin: longest first, each into the open bin with the least room that holds it.

    The open bins' rooms are bits of one integer, so that the next larger room is a shift and a lowest set bit."""
    which, offset, fill = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64), []
    by_room: dict[int, list[int]] = {}
    rooms = 0
    for i in np.argsort(-sizes, kind="stable"):
        size = int(sizes[i])
        if over := rooms >> size:
            room = size + (over & -over).bit_length() - 1
            bins = by_room[room]
            b = bins.pop()
            if not bins:
                rooms &= ~(1 << room)
        else:
            b, room = len(fill), capacity
            fill.append(0)
        which[i], offset[i] = b, fill[b]
        fill[b] += size
        if left := room - size:
            by_room.setdefault(left, []).append(b)
            rooms |= 1 << left
    return which, offset, np.array(fill, np.int64)


def _pack_tasks(items: DataFrame, size_col: str, level: int, capacity: int, group: int) -> DataFrame:
    """Adds _bin (unique over levels, tasks and groups), _offset, _fill, _carried and _group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, bins, held, count, number = TaskContext.get().partitionId(), 0, [], 0, 0

        def packed() -> Iterator[pa.RecordBatch]:
            nonlocal bins, held, count, number
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            which, offset, fill = best_fit(rows.column(size_col).to_numpy(zero_copy_only=False), capacity)
            added = [(level << 58) + (task << 32) + bins + which, offset, fill[which], (fill < capacity - NEARLY_FULL)[which], np.full(len(which), (task << 20) + number)]
            bins, held, count, number = bins + len(fill), [], 0, number + 1
            out = pa.record_batch([*rows.columns, *map(pa.array, added)], names=[*rows.schema.names, "_bin", "_offset", "_fill", "_carried", "_group"])
            for at in range(0, len(which), 10_000):
                yield out.slice(at, 10_000)

        for batch in batches:
            for at in range(0, batch.num_rows, group):
                part = batch.slice(at, group)
                if count and count + part.num_rows > group:
                    yield from packed()
                held.append(part)
                count += part.num_rows
        if held:
            yield from packed()

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema)
    return items.mapInArrow(run, f"{kinds}, _bin long, _offset long, _fill long, _carried boolean, _group long")


def pack(items: DataFrame, size_col: str, scratch: Scratch, capacity: int = CAPACITY, fan_in: int = FAN_IN, group: int = GROUP) -> DataFrame:
    """The items with sequence_id and offset; every size must be from 1 to the capacity. The fill is best where partitions hold a random mix of sizes in random order."""
    first = scratch.cut(_pack_tasks(items, size_col, 0, capacity, group))
    underfull = lambda done: done.where("_carried").select(F.col("_bin").alias("item"), F.col("_fill").alias("size")).distinct()
    groups, left, moved, level = first.agg(F.countDistinct("_group")).first()[0], scratch.cut(underfull(first)), None, 1
    n = left.count()
    while groups > 1 and n:
        groups = max(-(-groups // fan_in), -(-5 * n // (4 * group)))
        done = scratch.cut(_pack_tasks(left.repartition(groups, F.xxhash64("item", F.lit(level))), "size", level, capacity, group))
        step = done.select("item", F.col("_bin").alias("to"), F.col("_offset").alias("by"))
        if moved is None:
            moved = step
        else:
            later = step.select(F.col("item").alias("to"), F.col("to").alias("then"), F.col("by").alias("more"))
            moved = moved.join(later, "to", "left").select("item", F.coalesce("then", "to").alias("to"), (F.col("by") + F.coalesce("more", F.lit(0))).alias("by"))
        scratch.drop(left)
        left, before = scratch.cut(underfull(done)), n
        n = left.count()
        if n == before and done.where("NOT _carried").isEmpty():
            break
        level += 1
    scratch.drop(left)
    keep = items.columns
    if moved is None:
        return first.select(*keep, F.col("_bin").alias("sequence_id"), F.col("_offset").alias("offset"))
    placed = first.join(moved.withColumnRenamed("item", "_bin"), "_bin", "left")
    return placed.select(*keep, F.coalesce("to", "_bin").alias("sequence_id"), (F.col("_offset") + F.coalesce("by", F.lit(0))).alias("offset"))


def pack_documents(df: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", path: str = "", capacity: int = CAPACITY) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of every document."""
    if id_col in PLACES:
        raise ValueError(f"{id_col} is a column of the result")
    key = (id_col, "piece", "ids_crc32")
    mixed = pieces(df, id_col, text_col, path, capacity).repartition(*key).sortWithinPartitions(F.xxhash64(*key))
    return pack(mixed, "length", scratch, capacity)
