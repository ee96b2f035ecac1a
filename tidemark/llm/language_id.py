"""Language identification by words first, then ever shorter character n-grams.

A word known from training scores by its log frequency in each language; an unseen word by the mean log frequency of its
longest character n-grams that are known, tried from ``MAX_N`` down to single characters. A text's language has the highest sum,
ties by the name; the score is its share among all languages.

Training reads at most ``per_language`` documents of each language in expectation, chosen by a hash of the id, and keeps all their
words and n-grams; prediction reads whole texts and nothing but the text. Text that is null or has no letter is ``und`` with score 0, as is every text when nothing was learned. An empty
table gives no rows; repeated rows are judged alike; further columns are ignored.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_column, fold, near_fraction

PER_LANGUAGE = 1500
MAX_N = 4
UNKNOWN = "und"
WORD = re.compile(r"[^\W\d_]+")
REMEMBERED = 50_000


class Model:
    """Scores of words and of n-grams, a row of one entry per language for each."""

    def __init__(self, languages: list[str], counts: dict[str, dict[str, int]]):
        """counts: by language, the count of each word. All words and all their n-grams are kept."""
        self.languages = languages
        at: dict[str, int] = {}
        for lang in languages:
            for word in counts.get(lang, {}):
                at.setdefault(word, len(at))
        by_word = np.zeros((len(at), len(languages)))
        for k, lang in enumerate(languages):
            of = counts.get(lang, {})
            by_word[np.fromiter(map(at.__getitem__, of), np.int64, len(of)), k] = np.fromiter(of.values(), float, len(of))
        self.words, self.word_logs = at, self._logs(by_word)
        self.grams: list[tuple[dict[str, int], np.ndarray]] = []
        for size in range(1, MAX_N + 1):
            grams: dict[str, int] = {}
            row, of_word = array("q"), array("q")
            for w, j in at.items():
                padded = f" {w} " if size > 1 else w
                for i in range(len(padded) - size + 1):
                    row.append(grams.setdefault(padded[i : i + size], len(grams)))
                    of_word.append(j)
            rows, words = np.frombuffer(row, np.int64), np.frombuffer(of_word, np.int64)
            sums = [np.bincount(rows, by_word[words, k], len(grams)) for k in range(len(languages))]
            self.grams.append((grams, self._logs(np.stack(sums, 1) if sums else np.zeros((0, 0)))))

    @staticmethod
    def _logs(rows: np.ndarray) -> np.ndarray:
        return np.log(rows + 0.5) - np.log(rows.sum(0) + 0.5 * len(rows)) if len(rows) else rows

    def word(self, w: str) -> np.ndarray:
        if (known := self.words.get(w)) is not None:
            return self.word_logs[known]
        for size in range(MAX_N, 0, -1):
            padded, (table, logs) = f" {w} " if size > 1 else w, self.grams[size - 1]
            if hits := [x for i in range(len(padded) - size + 1) if (x := table.get(padded[i : i + size])) is not None]:
                return logs[hits].mean(0)
        return np.zeros(len(self.languages))


class Predictor:
    """A model with the vectors of REMEMBERED words seen lately as rows of one matrix."""

    def __init__(self, model: Model):
        self.model, self.row, self.matrix = model, {}, np.zeros((REMEMBERED, len(model.languages)))

    def text(self, text: str | None) -> tuple[str, float]:
        words = WORD.findall((text or "").lower())
        if not self.model.languages or not any(c.isalpha() for w in words for c in w):
            return UNKNOWN, 0.0
        counts = list(Counter(words).items())
        sums = sum((self._sums(counts[i : i + REMEMBERED]) for i in range(0, len(counts), REMEMBERED)), np.zeros(len(self.model.languages)))
        best = int(sums.argmax())
        return self.model.languages[best], 1 / float(np.exp(np.clip(sums - sums[best], -700, 0)).sum())

    def _sums(self, counts: list[tuple[str, int]]) -> np.ndarray:
        row = self.row
        if len(row) + len(counts) > REMEMBERED:
            row.clear()
        for w, _ in counts:
            if w not in row:
                self.matrix[len(row)] = self.model.word(w)
                row[w] = len(row)
        rows = np.fromiter((row[w] for w, _ in counts), np.int64, len(counts))
        return np.fromiter((n for _, n in counts), float, len(counts)) @ self.matrix[rows]


def fit(df: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> Model:
    """The model of the rows where ``learn`` holds, text and language non-null."""
    usable = df.where(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = {r["l"]: r["n"] for r in usable.groupBy(F.col(lang_col).alias("l")).agg(F.count("*").alias("n")).collect()}
    if not rows:
        return Model([], {})
    share = F.lit(0.0)
    for lang, n in sorted(rows.items()):
        share = F.when(F.col(lang_col) == lang, F.lit(min(1.0, per_language / n))).otherwise(share)
    words = F.explode(F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(r"(\p{L}+)"), 1))
    found = usable.where(near_fraction(F.col(id_col), share)).select(F.col(lang_col).alias("l"), words.alias("w")).groupBy("l", "w").agg(F.count("*").alias("n"))
    counts: dict[str, dict[str, int]] = defaultdict(dict)
    for batch in found.toArrow().to_batches():
        for lang, word, n in zip(*(batch.column(c).to_pylist() for c in ("l", "w", "n")), strict=True):
            counts[lang][word] = n
    return Model(sorted(rows), counts)


def predict(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, lang_pred, lang_score), with the columns in keep. Only the text goes to Python."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    cols = list(dict.fromkeys([id_col, *keep]))
    own: list[Predictor] = []

    def run(texts: pa.Array) -> pa.Array:
        if not own:
            own.append(Predictor(shared.value))
        found = [own[0].text(x.as_py()) for x in texts]
        return pa.StructArray.from_arrays([pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], names=["lang", "score"])

    judge = arrow_column(df.sparkSession, run, "lang string, score double")
    judged = df.select(*(F.col(c).alias(f"keep_{i}") for i, c in enumerate(cols)), judge(F.col(text_col)).alias("found"))
    return judged.select(*(F.col(f"keep_{i}").alias(c) for i, c in enumerate(cols)), F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("lang_score"))


def held_out(id_col: str = "doc_id") -> Column:
    return fold(F.col(id_col), 3) == 1
