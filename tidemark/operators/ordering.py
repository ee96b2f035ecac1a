"""Order of change events: latest per key, replays, ambiguity, and classification against what was accepted before.

Events of a key are ordered by source_lsn and then kafka_offset. An event's identity is its topic, partition and offset.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

IDENTITY = ("kafka_topic", "kafka_partition", "kafka_offset")
PERSISTED = {"source_lsn": "bigint", "kafka_partition": "int", "kafka_offset": "bigint"}
NEW, NEWER, STALE, AMBIGUOUS = "NEW", "NEWER", "STALE", "AMBIGUOUS_ORDERING"


@dataclass(frozen=True)
class Split:
    """Events that can be ordered, and those rejected within the run."""

    orderable: DataFrame
    ambiguous: DataFrame


@dataclass(frozen=True)
class Classified:
    accepted: DataFrame
    rejected: DataFrame


def latest_per_key(events: DataFrame, *key: str) -> DataFrame:
    """The last event of each key. Kept as row_number = 1, which Spark limits before the shuffle."""
    last_first = Window.partitionBy(*key).orderBy(F.desc("source_lsn"), F.desc("kafka_offset"))
    return events.withColumn("_place", F.row_number().over(last_first)).where("_place = 1").drop("_place")


def without_replays(events: DataFrame) -> DataFrame:
    """One of the copies of each event."""
    return events.dropDuplicates(list(IDENTITY))


def ambiguous_keys(events: DataFrame, key: str) -> DataFrame:
    """(key, source_lsn) that came over several partitions: no order between those events can be told.

    Two extremes suffice to see a second partition, and unlike a distinct count they are one aggregation."""
    ends = events.groupBy(key, "source_lsn").agg(F.min("kafka_partition").alias("_least"), F.max("kafka_partition").alias("_most"))
    return ends.where("_least < _most").select(key, "source_lsn")


def split_same_run(events: DataFrame, key: str) -> Split:
    once = without_replays(events)
    tied = ambiguous_keys(once, key)
    both = [key, "source_lsn"]
    lost_to = {f"persisted_{c}": F.lit(None).cast(kind) for c, kind in PERSISTED.items()}
    rejected = once.join(tied, both, "left_semi").withColumns({"cdc_status": F.lit(AMBIGUOUS), **lost_to, "rejected_at": F.current_timestamp()})
    return Split(once.join(tied, both, "left_anti"), rejected)


def replays(events: DataFrame, history: DataFrame) -> DataFrame:
    """Events that history holds."""
    return events.join(history.select(*IDENTITY), list(IDENTITY), "left_semi").select(*events.columns)


def unseen(events: DataFrame, history: DataFrame) -> DataFrame:
    return events.join(history.select(*IDENTITY), list(IDENTITY), "left_anti").select(*events.columns)


def with_status(fresh: DataFrame, history: DataFrame, key: str, latest: DataFrame | None = None) -> DataFrame:
    """Unseen events with cdc_status and the position of the key's latest event in history, or in ``latest``, which has one event for each key.

    Events are held against earlier runs only, never against each other."""
    last = latest_per_key(history.join(fresh.select(key).distinct(), key, "left_semi"), key) if latest is None else latest
    last = last.select(key, *(F.col(c).cast(kind).alias(f"persisted_{c}") for c, kind in PERSISTED.items()))
    status = F.expr(
        f"""CASE WHEN persisted_source_lsn IS NULL THEN '{NEW}'
                 WHEN source_lsn <> persisted_source_lsn THEN if(source_lsn > persisted_source_lsn, '{NEWER}', '{STALE}')
                 WHEN kafka_partition <> persisted_kafka_partition THEN '{AMBIGUOUS}'
                 WHEN kafka_offset > persisted_kafka_offset THEN '{NEWER}' ELSE '{STALE}' END"""
    )
    return fresh.join(last, key, "left").withColumn("cdc_status", status)


def classify(split: Split, history: DataFrame | None, key: str, latest: DataFrame | None = None) -> Classified:
    """With ``latest``, the last event of each of the batch's keys, history need only hold the batch's range of offsets. Accepted: new and newer events, and replays, so that a run that broke off after writing history can be caught up.
    Rejected: stale and ambiguous ones with what they lost to. history: None on the first run."""
    if history is None:
        return Classified(split.orderable, split.ambiguous)
    columns = split.orderable.columns
    judged = with_status(unseen(split.orderable, history), history, key, latest)
    accepted = judged.where(F.col("cdc_status").isin(NEW, NEWER)).select(*columns)
    lost = judged.where(F.col("cdc_status").isin(STALE, AMBIGUOUS)).withColumn("rejected_at", F.current_timestamp())
    return Classified(accepted.unionByName(replays(split.orderable, history)), lost.unionByName(split.ambiguous))
