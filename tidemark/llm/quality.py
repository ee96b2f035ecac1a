"""Quality classifier: random-indexing word vectors pooled per document, then a two-layer numpy network.

Every word has a sparse ternary index vector drawn from a hash of it. A word's vector is the normalised sum of the index vectors around its
occurrences in the sample (random indexing), that of a word the sample lacks its index vector; every word of the sample has one. A token's shape
(capitals, digits, marks) is indexed likewise. A document is the mean over its tokens; tokens of over PIECE characters count as several. The network is trained on
these means; a temperature fitted on held-back rows calibrates its probabilities.

Training reads at most ``rows`` labelled documents in expectation, chosen by a hash of the id; scoring reads whole texts and nothing
but the text. Null and empty texts have a zero vector and get the network's score for it. Without labels of both kinds
the score is the share of good labels (1 without any). Several labels of one document count as their least. An empty
table gives no rows; repeated rows are judged alike; further columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, arrow_column, fold, map_batches, mix, near_fraction

ROWS = 8000
DIM = 32
NONZERO = 6
WINDOW = 2
HIDDEN = 24
THRESHOLD = 0.3
REMEMBERED = 100_000
PIECE = 64
EDGES, RUN = re.compile(r"^\W+|\W+$"), re.compile(r"(.)\1+", re.DOTALL)
KINDS = {i: "9" if chr(i).isdigit() else "A" if chr(i).isupper() else "a" for i in range(128) if chr(i).isalnum()}


def hashes(words: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in words), np.uint64, len(words))


def index_vectors(h: np.ndarray) -> np.ndarray:
    """For each word's hash NONZERO entries of plus or minus one, places and signs from the hash."""
    out = np.zeros((len(h), DIM), np.float32)
    for k in range(NONZERO):
        x = mix(h + np.uint64(k))
        out[np.arange(len(h)), (x % np.uint64(DIM)).astype(np.int64)] += np.where(x >> np.uint64(63), 1, -1)
    return out


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=-1, keepdims=True), 1e-6)


def shape(token: str) -> str:
    """Letters as A or a, digits as 9, runs of a kind as one; other marks stay."""
    if token.isascii():
        return RUN.sub(r"\1", token.translate(KINDS))
    kinds = ["A" if c.isupper() else "a" if c.isalpha() else "9" if c.isdigit() else c for c in token]
    return "".join(c for i, c in enumerate(kinds) if not i or c != kinds[i - 1])


def pieces(text: str) -> list[str]:
    """Tokens between white space; longer ones than PIECE in pieces of it, so that text without spaces is pooled whole."""
    return [t[i : i + PIECE] for t in text.split() for i in range(0, len(t), PIECE)]


def core(token: str) -> str:
    return token.lower() if token.isalnum() else EDGES.sub("", token).lower()


@dataclass
class Model:
    #: Hashes of the sample's words in order, and the words' vectors.
    words: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    vectors: np.ndarray = field(default_factory=lambda: np.zeros((0, DIM), np.float16))
    centre: np.ndarray | None = None
    spread: np.ndarray | None = None
    layers: tuple[np.ndarray, ...] = ()
    temperature: float = 1.0
    constant: float = 1.0

    def score(self, features: np.ndarray) -> np.ndarray:
        if not self.layers:
            return np.full(len(features), self.constant)
        z = forward(self.layers, (features - self.centre) / self.spread)[1] / self.temperature
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


class Pooler:
    """Document vectors; keeps the rows of REMEMBERED tokens seen lately."""

    def __init__(self, words: np.ndarray, vectors: np.ndarray):
        self.words, self.vectors, self.row, self.matrix = words, vectors, {}, np.zeros((REMEMBERED, 2 * DIM), np.float16)
        self.shapes: dict[str, np.ndarray] = {}

    def text(self, text: str | None) -> np.ndarray:
        counts = list(Counter(pieces(text or "")).items())
        sums = sum((self._sums(counts[i : i + REMEMBERED]) for i in range(0, len(counts), REMEMBERED)), np.zeros(2 * DIM, np.float32))
        return sums / max(1, sum(n for _, n in counts))

    def _sums(self, counts: list[tuple[str, int]]) -> np.ndarray:
        if len(self.row) + len(counts) > REMEMBERED:
            self.row.clear()
        row, new = self.row, [t for t, _ in counts if t not in self.row]
        if new:
            cores = [core(t) for t in new]
            h = hashes(cores)
            at = np.minimum(np.searchsorted(self.words, h), max(0, len(self.words) - 1))
            known = self.words[at] == h if len(self.words) else np.zeros(len(h), bool)
            block = self.matrix[len(row) : len(row) + len(new)]
            block[known, :DIM] = self.vectors[at[known]]
            block[~known, :DIM] = unit(index_vectors(h[~known])) * np.array([bool(w) for w in cores], np.float32)[~known, None]
            forms = [shape(t) for t in new]
            if fresh := list(set(forms) - self.shapes.keys()):
                if len(self.shapes) > REMEMBERED:
                    self.shapes.clear()
                    fresh = list(set(forms))
                self.shapes.update(zip(fresh, index_vectors(hashes(fresh)), strict=True))
            block[:, DIM:] = [self.shapes[s] for s in forms]
            for t in new:
                row[t] = len(row)
        rows, n = np.array([row[t] for t, _ in counts]), np.array([n for _, n in counts], np.float32)
        return n @ self.matrix[rows].astype(np.float32)


def forward(layers: tuple[np.ndarray, ...], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    w1, b1, w2, b2 = layers
    h = np.tanh(x @ w1 + b1)
    return h, (h @ w2 + b2)[:, 0]


def train(x: np.ndarray, y: np.ndarray, epochs: int = 60, batch: int = 128, rate: float = 3e-3, decay: float = 1e-4, seed: int = 0) -> tuple[np.ndarray, ...]:
    """A tanh layer and a logistic one by Adam on the cross entropy."""
    rng = np.random.default_rng(seed)
    layers = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 1)), np.zeros(1)]
    first, second, step = [np.zeros_like(p) for p in layers], [np.zeros_like(p) for p in layers], 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), batch):
            i = order[at : at + batch]
            h, z = forward(layers, x[i])
            dz = ((1 / (1 + np.exp(-np.clip(z, -500, 500)))) - y[i])[:, None] / len(i)
            dh = dz @ layers[2].T * (1 - h * h)
            grads = [x[i].T @ dh + decay * layers[0], dh.sum(0), h.T @ dz + decay * layers[2], dz.sum(0)]
            step += 1
            for p, g, m, v in zip(layers, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return tuple(layers)


def calibrate(z: np.ndarray, y: np.ndarray) -> float:
    """The temperature of the least cross entropy on held-back rows, from a geometric grid."""
    grid = np.geomspace(0.25, 8, 81)
    loss = [np.logaddexp(0, -np.where(y > 0, 1, -1) * z / t).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def _contexts(sample: DataFrame, text_col: str) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the sample's words, in order, and the words' vectors."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [[core(t) for t in pieces(x.as_py() or "")] for x in batch.column(0)]
        words = sorted({w for t in texts for w in t if w})
        at, h = {w: i for i, w in enumerate(words)}, hashes(words)
        index = np.vstack([index_vectors(h), np.zeros((1, DIM), np.float32)])
        sums = np.zeros_like(index)
        for t in texts:
            ids = np.array([at.get(w, len(words)) for w in t], np.int64)
            for off in range(1, WINDOW + 1):
                np.add.at(sums, ids[:-off], index[ids[off:]])
                np.add.at(sums, ids[off:], index[ids[:-off]])
        flat = pa.array(sums[:-1].astype(np.int32).ravel())
        return pa.record_batch([pa.array(h.view(np.int64)), pa.ListArray.from_arrays(pa.array(np.arange(len(h) + 1, dtype=np.int32) * DIM), flat)], names=["word", "vec"])

    parts = map_batches(sample.select(text_col), run, "word long, vec array<int>")
    # sums of whole numbers: the same whatever the partitioning. They grow with the sample, whose size is bounded
    sums = parts.groupBy("word").agg(*(F.sum(F.col("vec")[i]).cast("int").alias(f"d{i}") for i in range(DIM))).toArrow()
    words = sums.column("word").to_numpy().view(np.uint64)
    order = np.argsort(words)
    vectors = np.stack([sums.column(f"d{i}").to_numpy().astype(np.float32) for i in range(DIM)], 1)
    return words[order], unit(vectors)[order].astype(np.float16)


def fit(docs: DataFrame, labels: DataFrame, learn: Column, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", rows: int = ROWS) -> Model:
    """learn: which ids of the labels may be used."""
    usable = labels.where(learn & F.col(label_col).isin(0, 1)).groupBy(id_col).agg(F.min(label_col).alias("y"))
    n, good = usable.agg(F.count("*"), F.sum("y")).first()
    if not n or good in (0, n):
        return Model(constant=good / n if n else 1.0)
    chosen = usable.where(near_fraction(F.col(id_col), F.lit(min(1.0, rows / n))))
    # the choice has about ``rows`` rows of two numbers at most, which bounds the broadcast
    sample = scratch.cut(docs.select(id_col, text_col).join(F.broadcast(chosen), id_col).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col("y").cast("double").alias("y")))
    words, vectors = _contexts(sample, "text")
    pooled = features(sample, words, vectors, ("id", "y")).toPandas().sort_values("id")
    scratch.drop(sample)
    x, y = np.stack(pooled["vec"]).astype(float) if len(pooled) else np.zeros((0, 2 * DIM)), pooled["y"].to_numpy()
    back = np.array([zlib.crc32(f"back {i}".encode()) % 5 == 0 for i in pooled["id"]], bool)
    if len(set(y[~back])) < 2:
        return Model(constant=good / n)
    model = Model(words, vectors, x[~back].mean(0), x[~back].std(0) + 1e-3, constant=good / n)
    model.layers = train((x[~back] - model.centre) / model.spread, y[~back])
    if back.any():
        model.temperature = calibrate(forward(model.layers, (x[back] - model.centre) / model.spread)[1], y[back])
    return model


def features(df: DataFrame, words: np.ndarray, vectors: np.ndarray, keep: tuple[str, ...], text_col: str = "text") -> DataFrame:
    """vec, with the columns in keep."""
    shared = df.sparkSession.sparkContext.broadcast((words, vectors))
    own: list[Pooler] = []

    def run(texts: pa.Array) -> pa.Array:
        if not own:
            own.append(Pooler(*shared.value))
        return pa.array([own[0].text(x.as_py()) for x in texts], pa.list_(pa.float32()))

    return df.select(*keep, arrow_column(df.sparkSession, run, "array<float>")(F.col(text_col)).alias("vec"))


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, quality_score, predicted), with the columns in keep. Only the text goes to Python."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    cols = list(dict.fromkeys([id_col, *keep]))
    own: list[Pooler] = []

    def run(texts: pa.Array) -> pa.Array:
        if not own:
            own.append(Pooler(shared.value.words, shared.value.vectors))
        pooled = [own[0].text(x.as_py()) for x in texts]
        return pa.array(shared.value.score(np.stack(pooled).astype(float)) if pooled else [], pa.float64())

    judge = arrow_column(df.sparkSession, run, "double")
    judged = df.select(*(F.col(c).alias(f"keep_{i}") for i, c in enumerate(cols)), judge(F.col(text_col)).alias("score"))
    return judged.select(*(F.col(f"keep_{i}").alias(c) for i, c in enumerate(cols)), F.col("score").alias("quality_score"), (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def held_out(id_col: str = "doc_id") -> Column:
    return fold(F.col(id_col), 5) == 0
