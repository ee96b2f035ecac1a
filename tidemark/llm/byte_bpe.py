"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

The library's model is built from the ranks of a ``.tiktoken`` file whose path is a parameter: a byte table gives each byte a printable character, so that
every token is a string, and each way to put a token together from two others is a merge of the token's rank. Every match of the split pattern is encoded
by itself; a match that is a token is that token. No special token is recognised, so their strings in a text are ordinary text.

Ids come with two places: the byte at which the token starts, from the byte table, and the character it starts in, from the library's offsets. ``decode`` reverses
the byte table; a character split over several ids appears with the id that completes it.

Null text counts as empty (no ids, empty text); empty text has no ids; ids that the table lacks decode to nothing when ``errors='ignore'`` and raise KeyError
otherwise, as do null ids; null ``ids`` count as none. Repeated rows and any further columns don't matter: only the named columns are read. Empty tables give no rows.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tidemark.llm.common import map_batches

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Matches whose ids a worker keeps, and the longest that it keeps, in characters; others are encoded each time.
REMEMBERED, KEPT_LENGTH = 400_000, 64


@lru_cache(maxsize=1)
def byte_characters() -> tuple[str, ...]:
    """The printable character that stands for each byte: itself where printable, else the next free one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return tuple(chr(b) if b in shown else chr(next(spare)) for b in range(256))


def visible(token: bytes) -> str:
    """A token's bytes as characters."""
    table = byte_characters()
    return "".join(table[b] for b in token)


@lru_cache(maxsize=1)
def _bytes_of() -> dict[str, int]:
    return {c: b for b, c in enumerate(byte_characters())}


def from_visible(token: str) -> bytes:
    return bytes(map(_bytes_of().__getitem__, token))


def merges(ranks: dict[bytes, int]) -> list[tuple[str, str]]:
    """All pairs of tokens that make a token, in the order of its rank."""
    out = []
    for token, _ in sorted(ranks.items(), key=lambda x: x[1]):
        pairs = [(token[:i], token[i:]) for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks]
        out += [(visible(a), visible(b)) for a, b in sorted(pairs, key=lambda p: (ranks[p[0]], ranks[p[1]]))]
    return out


class Codec:
    def __init__(self, path: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, models, pre_tokenizers

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        vocabulary = {visible(token): rank for token, rank in ranks.items()}
        self.library = Tokenizer(models.BPE(vocab=vocabulary, merges=merges(ranks), ignore_merges=True))
        self.library.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, trim_offsets=False, use_regex=False)
        self.tokens = {rank: from_visible(token) for token, rank in vocabulary.items()}
        self.decimal = {rank: str(rank) for rank in self.tokens}
        self.pattern, self.known, self.decoded = regex.compile(pattern), {}, {}

    def _encoded(self, words: list[str]) -> Iterator[tuple[list[int], list[tuple[int, int]], list[tuple[int, int]]]]:
        """By up to 1000 matches at a call: their ids, the ids' offsets, each in its own match, and from where to where each match's ids go."""
        for at in range(0, len(words), 1000):
            e = self.library.encode_batch([words[at : at + 1000]], is_pretokenized=True, add_special_tokens=False)[0]
            ids = e.ids
            starts = [0, *(np.flatnonzero(np.diff(np.array(e.word_ids))) + 1).tolist(), len(ids)]
            yield ids, e.offsets, list(zip(starts, starts[1:], strict=False))

    def written(self, texts: list[str]) -> list[tuple[str, bytes]]:
        """For each text its ids in decimal, joined by commas, and what they decode to. Both are remembered by match."""
        found = [self.pattern.findall(x) for x in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
            self.decoded.clear()
        new = list(set().union(*found).difference(self.known))
        at = 0
        for ids, _, ranges in self._encoded(new):
            part = new[at : at + len(ranges)]
            decimals, raw = list(map(self.decimal.__getitem__, ids)), list(map(self.tokens.__getitem__, ids))
            self.known.update(zip(part, [decimals[a] if b - a == 1 else ",".join(decimals[a:b]) for a, b in ranges], strict=True))
            self.decoded.update(zip(part, [raw[a] if b - a == 1 else b"".join(raw[a:b]) for a, b in ranges], strict=True))
            at += len(part)
        out = [(",".join(map(self.known.__getitem__, words)), b"".join(map(self.decoded.__getitem__, words))) for words in found]
        for w in new:
            if len(w) > KEPT_LENGTH:
                del self.known[w], self.decoded[w]
        return out

    def encode(self, text: str) -> tuple[list[int], list[int], list[int]]:
        """Ids, and the byte and the character at which each starts."""
        matches = [(m[0], m.start()) for m in self.pattern.finditer(text)]
        ids: list[int] = []
        characters: list[int] = []
        at = 0
        for part, offsets, ranges in self._encoded([w for w, _ in matches]):
            ids += part
            for (_, start), (a, b) in zip(matches[at : at + 1000], ranges, strict=True):
                characters += [start + offsets[k][0] for k in range(a, b)]
            at += 1000
        sizes = [len(self.tokens[i]) for i in ids]
        return ids, [0, *np.cumsum(sizes).tolist()][: len(ids)], characters

    def decode(self, ids: list[int], errors: str = "strict") -> bytes:
        if errors == "ignore":
            ids = [i for i in ids if i in self.tokens]
        return b"".join(map(self.tokens.__getitem__, ids))

    def pieces(self, ids: list[int]) -> list[str]:
        """The characters that each id completes; bytes that are no UTF-8 come as the replacement character."""
        whole = codecs.getincrementaldecoder("utf-8")("replace")
        return [whole.decode(self.tokens.get(i, b""), final=k == len(ids) - 1) for k, i in enumerate(ids)]


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = "", pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """(id, ids array<int>, starts array<long>, characters array<long>) of each row."""
    path = path or public_tokenizers.path(VOCABULARY)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [codec(path, pattern).encode(x.as_py() or "") for x in batch.column(1)]
        columns = [pa.array([x[k] for x in found], pa.list_(kind)) for k, kind in enumerate((pa.int32(), pa.int64(), pa.int64()))]
        return pa.record_batch([batch.column(0), *columns], names=[id_col, "ids", "starts", "characters"])

    return map_batches(df.select(id_col, text_col), run, f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, ids array<int>, starts array<long>, characters array<long>")


def decode(df: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str = "", errors: str = "strict") -> DataFrame:
    """(id, bytes, text, pieces) of each row of ids; text is null where the bytes are not UTF-8, pieces holds the characters that each id completes."""
    path = path or public_tokenizers.path(VOCABULARY)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = codec(path, public_tokenizers.PATTERN)
        ids = [x.as_py() or [] for x in batch.column(1)]
        raw, texts = [own.decode(x, errors) for x in ids], []
        for x in raw:
            try:
                texts.append(x.decode())
            except UnicodeDecodeError:
                texts.append(None)
        return pa.record_batch([batch.column(0), pa.array(raw, pa.binary()), pa.array(texts, pa.string()), pa.array([own.pieces(x) for x in ids], pa.list_(pa.string()))], names=[id_col, "bytes", "text", "pieces"])

    return map_batches(df.select(id_col, ids_col), run, f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, bytes binary, text string, pieces array<string>")


def round_trip(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = "", pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256, same): encodes and decodes in one pass without moving ids between processes."""
    path = path or public_tokenizers.path(VOCABULARY)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own, texts = codec(path, pattern), [x.as_py() or "" for x in batch.column(1)]
        counts, id_hashes, text_hashes, same = [], [], [], []
        for at in range(0, len(texts), 64):
            for text, (decimals, back) in zip(texts[at : at + 64], own.written(texts[at : at + 64]), strict=True):
                counts.append(decimals.count(",") + bool(decimals))
                id_hashes.append(hashlib.sha256(decimals.encode()).hexdigest())
                text_hashes.append(hashlib.sha256(back).hexdigest())
                same.append(back == text.encode())
        return pa.record_batch([batch.column(0), pa.array(counts, pa.int64()), pa.array(id_hashes, pa.string()), pa.array(text_hashes, pa.string()), pa.array(same, pa.bool_())], names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256", "same"])

    kind = df.schema[id_col].dataType.simpleString()
    return map_batches(df.select(id_col, text_col), run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, same boolean")
