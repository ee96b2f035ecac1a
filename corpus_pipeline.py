"""The corpus pipeline: quality, language, near-duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the last return the columns of ``documents``. The two
models are fitted on the table that the labels belong to, ``documents`` in sf_dir, so that they do not depend on what earlier stages kept.

Null and empty texts: the quality model scores them like any other, language ID rejects them, as it does texts without a letter. From the
near-duplicate stage on, equal rows are one document, and so are rows without an id that have one text; rows of one id with different texts stay or go together. Empty tables give no rows;
columns beyond those of ``documents`` are dropped. Only texts and results pass through Python in the first two stages; the other columns stay in the JVM.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import language_id, minhash, packing, quality, suffix_dedup
from tidemark.llm.common import Scratch, table

#: Stand-ins for missing ids start here, above all ids in use.
NO_ID = 1 << 62
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality classifier accepts."""
    model = quality.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~quality.held_out(), Scratch(spark))
    return quality.score(docs, model, keep=COLUMNS).where("predicted = 1").select(*COLUMNS)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language is one of the learned ones; lang becomes the predicted language."""
    model = language_id.fit(table(spark, sf_dir, "documents"), ~language_id.held_out())
    found = language_id.predict(docs, model, keep=("text", "source", "n_chars"))
    return found.where(F.col("lang_pred") != language_id.UNKNOWN).withColumnRenamed("lang_pred", "lang").select(*COLUMNS)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8): the one with the smallest id; one without an id only where none has one."""
    scratch = Scratch(spark)
    stand_in = F.pmod(F.xxhash64("text"), F.lit(NO_ID)) + F.lit(NO_ID)
    named = docs.select(*COLUMNS, F.coalesce(F.col("doc_id").cast("long"), stand_in).alias("_id"))
    kept = scratch.cut(minhash.near_duplicates(named, scratch, id_col="_id").where("kept").select("_id").distinct())
    return named.join(kept, "_id").dropDuplicates(["_id", "text"]).select(*COLUMNS)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of 100-byte strings, cut at whole characters: a character of which any byte is a first copy stays whole.

    Documents of which nothing is left go."""
    out = suffix_dedup.dedup(docs, Scratch(spark), keep=("lang", "source"))
    left = out.where(F.length("kept") > 0).withColumnRenamed("kept", "text")
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the remaining documents with their places in sequences."""
    return packing.pack_documents(docs, Scratch(spark))


STAGES = [
    ("quality classifier", good_quality),
    ("language ID", known_language),
    ("MinHash near-dedup", without_near_duplicates),
    ("suffix-array dedup", without_repeats),
    ("best-fit packing", packed),
]

#: No SQL expresses the fitted models of the first stages; tests hold the others against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark)
    for _, stage in STAGES[:-1]:
        docs = scratch.cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
