"""The change envelope in a record's value: parse it, choose the record it is about, make a typed event of it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.schema import struct

# fixed values: the envelope's fields
SOURCE_FIELDS = "version string, connector string, name string, ts_ms bigint, snapshot string, db string, sequence string, ts_us bigint, ts_ns bigint, schema string, table string, txId bigint, lsn bigint, xmin bigint"
EVENT_META = ("cdc_timestamp", "source_timestamp", "cdc_operation", "source_lsn", "kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp", "is_tombstone", "ingested_at")


def envelope_schema(record: StructType) -> StructType:
    payload = StructType().add("before", record).add("after", record).add("source", struct(SOURCE_FIELDS)).add("op", "string")
    for name in ("ts_ms", "ts_us", "ts_ns"):
        payload = payload.add(name, "long")
    return StructType().add("payload", payload)


def parse(bronze: DataFrame, record: StructType, column: str = "debezium") -> DataFrame:
    """Adds the parsed envelope; text that is no such JSON gives nulls, which the quality rules then name."""
    return bronze.withColumn(column, F.from_json("raw_value", envelope_schema(record)))


def effective_record(parsed: DataFrame, out: str, column: str = "debezium") -> DataFrame:
    """Adds the record that the change is about: as it was for a delete, else as it has become."""
    return parsed.withColumn(out, F.expr(f"if({column}.payload.op <=> 'd', {column}.payload.before, {column}.payload.after)"))


def without_tombstones(df: DataFrame) -> DataFrame:
    """Rows known not to be tombstones."""
    return df.where("NOT is_tombstone")


def normalise(df: DataFrame, record: str, columns: Mapping[str, str], column: str = "debezium") -> DataFrame:
    """Flat events: the entity's columns, given as SQL over ``r`` for the record, then the event's own."""
    meta = {
        "cdc_timestamp": f"timestamp_millis({column}.payload.ts_ms)", "source_timestamp": f"timestamp_millis({column}.payload.source.ts_ms)", "cdc_operation": f"{column}.payload.op", "source_lsn": f"{column}.payload.source.lsn",
    }
    own = (F.expr(e.replace("r.", f"{record}.")).alias(c) for c, e in columns.items())
    return df.select(*own, *(F.expr(e).alias(c) for c, e in meta.items()), *EVENT_META[4:])
