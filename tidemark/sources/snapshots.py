"""Authoritative snapshots: headered CSV, metadata, validation, strict keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.entities import EntitySpec
from tidemark.functions.text import bool_of_text
from tidemark.operators import rules


def load(spark: SparkSession, path: str, spec: EntitySpec) -> DataFrame:
    """The file's rows; a value that doesn't fit its type is null, booleans are read from text."""
    rows = spark.read.option("header", True).schema(spec.snapshot_schema).csv(path)
    return rows.withColumns({c: bool_of_text(F.col(c)) for c in spec.snapshot_booleans}) if spec.snapshot_booleans else rows


# fixed values: names of the metadata, the batch and the file, and the schema's version
BATCH, FILE, SCHEMA_VERSION = "{entity}_snapshot_", ".csv", 1


def with_metadata(df: DataFrame, entity: str, as_of: str) -> DataFrame:
    """Adds where the rows come from: cutoff, its date, the batch, the file, the schema's version and the time of reading."""
    cutoff, name = F.lit(as_of).cast("timestamp"), F.lit(BATCH.format(entity=entity))
    day = lambda shape: F.concat(name, F.date_format(cutoff, shape))
    added = {"snapshot_as_of": cutoff, "source_date": cutoff.cast("date"), "batch_id": day("yyyyMMdd"), "source_filename": F.concat(day("yyyy-MM-dd"), F.lit(FILE)), "schema_version": F.lit(SCHEMA_VERSION), "ingested_at": F.current_timestamp()}
    return df.select("*", *(column.alias(c) for c, column in added.items()))


def tagged(df: DataFrame, spec: EntitySpec, as_of: str) -> DataFrame:
    return df.withColumn("snapshot_errors", rules.codes(spec.snapshot_rules(as_of)))


def validated(df: DataFrame, spec: EntitySpec, as_of: str) -> tuple[DataFrame, DataFrame]:
    """(rows fit for comparison, rows that are not, with snapshot_errors): valid rows whose key no other valid row has."""
    seen = tagged(df, spec, as_of)
    good = seen.where(F.size("snapshot_errors") == 0)
    twice = rules.repeated_keys(good, spec.key).select(spec.key)
    repeated = good.join(twice, spec.key, "left_semi").withColumn("snapshot_errors", F.array(F.lit(f"DUPLICATE_{spec.key.upper()}")))
    return good.join(twice, spec.key, "left_anti").drop("snapshot_errors").select(*df.columns), seen.where(F.size("snapshot_errors") > 0).unionByName(repeated)
