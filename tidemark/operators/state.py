"""State of a log at a cutoff, intervals between cutoffs, and how one state becomes the next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordering import latest_per_key


def cutoff(df: DataFrame, as_of: str, column: str = "source_timestamp") -> Column:
    """The cutoff as a literal of the column's own type, so that the comparison reaches the scan."""
    return F.lit(as_of).cast(df.schema[column].dataType)


def latest_as_of(history: DataFrame, as_of: str, key: str) -> DataFrame:
    """The last event of each key up to the cutoff, deletes left out, with the cutoff as state_updated_as_of."""
    upto = history.where(F.col("source_timestamp") <= cutoff(history, as_of))
    live = latest_per_key(upto, key).where("cdc_operation <> 'd'")
    return live.withColumn("state_updated_as_of", F.lit(as_of).cast("timestamp"))


def interval(history: DataFrame, after: str, upto: str) -> DataFrame:
    """Events after one cutoff and up to the next."""
    at = F.col("source_timestamp")
    return history.where((at > cutoff(history, after)) & (at <= cutoff(history, upto)))


def latest_of_interval(changes: DataFrame, key: str, as_of: str) -> DataFrame:
    """The last change of each key; deletes stay, since the next state has to lose those keys."""
    return latest_per_key(changes, key).withColumn("state_updated_as_of", F.lit(as_of).cast("timestamp"))


def late_events(history: DataFrame, as_of: str) -> DataFrame:
    """Events up to a processed cutoff that arrived after it: no later interval holds them."""
    return history.where((F.col("source_timestamp") <= cutoff(history, as_of)) & (F.col("ingested_at") > F.lit(as_of).cast("timestamp")))


def high_water_mark(metadata: DataFrame) -> DataFrame:
    return metadata.agg(F.max("state_as_of").alias("state_as_of"))
