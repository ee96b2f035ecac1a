"""The Spark session of a set of settings, and one call that makes a process ready."""

from __future__ import annotations

from functools import cache

from pyspark.sql import SparkSession

from tidemark.platform.config import Settings, get_settings


@cache
def get_session(settings: Settings) -> SparkSession:
    spark, storage = settings.spark, settings.storage
    conf = {
        "spark.sql.shuffle.partitions": str(spark.shuffle_partitions),
        "spark.sql.session.timeZone": spark.session_timezone,
        "spark.sql.autoBroadcastJoinThreshold": f"{spark.broadcast_size_mb}MB",
        "spark.sql.adaptive.enabled": str(spark.adaptive_query_execution).lower(),
    }
    if storage.mode == "object_store":
        conf |= {
            "spark.hadoop.fs.s3a.endpoint": storage.endpoint,
            "spark.hadoop.fs.s3a.access.key": storage.access_key,
            "spark.hadoop.fs.s3a.secret.key": str(storage.secret_key),
            "spark.hadoop.fs.s3a.path.style.access": "true",
        }
    return SparkSession.builder.appName(settings.application.name).master(spark.master).config(map=conf).getOrCreate()


def start(environment: str = "local") -> tuple[Settings, SparkSession]:
    settings = get_settings(environment)
    return settings, get_session(settings)
