"""Raw change records: from Kafka where its connector is on the class path, else from files with the same columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RECORD = "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp, headers array<struct<key:string,value:binary>>"


def from_kafka(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest", "includeHeaders": "true"}
    return spark.readStream.format("kafka").options(**options).load()


def from_files(spark: SparkSession, path: str, topic: str | None = None, streaming: bool = True) -> DataFrame:
    """Records of Parquet files in a folder, as a stream or a batch."""
    found = (spark.readStream if streaming else spark.read).schema(RECORD).parquet(path)
    return found.where(F.col("topic") == topic) if topic else found


def bronze_columns(records: DataFrame) -> DataFrame:
    """Records as the raw layer keeps them. A null value is a tombstone."""
    named = records.selectExpr(
        "CAST(key AS STRING) AS raw_key", "CAST(value AS STRING) AS raw_value", "headers AS kafka_headers", "topic AS kafka_topic", "partition AS kafka_partition", "offset AS kafka_offset", "timestamp AS kafka_timestamp",
    )
    return named.withColumn("is_tombstone", F.col("raw_value").isNull()).withColumn("ingested_at", F.current_timestamp()).withColumn("ingested_date", F.to_date("ingested_at"))
