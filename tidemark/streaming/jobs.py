"""The two streaming jobs of an entity: raw records to the append-only layer, and from there to the curated tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.entities import ENTITIES, EntitySpec
from tidemark.plans import silver
from tidemark.platform.log import get_logger
from tidemark.platform.paths import Layout
from tidemark.platform.session import start
from tidemark.sources import change_log

log = get_logger("streaming")
DOMAIN = "customer"


def _finish(name: str, query) -> None:
    try:
        query.awaitTermination()
    except Exception:
        log.error(f"{name}_failed")
        raise
    log.info(f"{name}_completed")


def write_bronze(name: str, records: DataFrame, path: str, checkpoint: str) -> None:
    """Appends everything available as Parquet by ingest date, then ends; the checkpoint keeps what was read."""
    rows = change_log.bronze_columns(records)
    writer = rows.writeStream.format("parquet").outputMode("append").partitionBy("ingested_date").option("checkpointLocation", checkpoint)
    _finish(f"{name}_bronze", writer.trigger(availableNow=True).start(path))


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """A stream over the raw layer with the schema that its files have."""
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)


def write_silver(bronze: DataFrame, spec: EntitySpec, tables: silver.SilverTables, checkpoint: str) -> None:
    writer = bronze.writeStream.foreachBatch(lambda df, batch_id: silver.process_batch(df, spec, tables, batch_id) and None)
    _finish(f"{spec.name}_silver", writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def run_bronze(entity: str, environment: str = "local", files: str | None = None) -> None:
    """files: a folder of records to read instead of Kafka."""
    spec, (settings, spark) = ENTITIES[entity], start(environment)
    layout = Layout.of(settings)
    path, checkpoint = (layout.at(place, domain=DOMAIN, entity=entity) for place in ("bronze_job", "bronze_job_checkpoint"))
    topic = getattr(settings.customer, spec.topic_setting)
    records = change_log.from_files(spark, files, topic) if files else change_log.from_kafka(spark, settings.kafka.bootstrap_servers, topic)
    write_bronze(entity, records, path, checkpoint)


def run_silver(entity: str, environment: str = "local") -> None:
    spec, (settings, spark) = ENTITIES[entity], start(environment)
    layout = Layout.of(settings)
    tables = silver.SilverTables.at(spark, lambda name: layout.at("silver_job", domain=DOMAIN, entity=entity, dataset=name), spec.key)
    of = {"domain": DOMAIN, "entity": entity}
    write_silver(read_bronze(spark, layout.at("bronze_job", **of)), spec, tables, layout.at("silver_job_checkpoint", **of))
