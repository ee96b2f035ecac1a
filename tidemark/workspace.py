"""Folders for tables that a query makes for itself: under the folder that all executors share."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_made: list[tuple[SparkSession, str]] = []
_local: list[str] = []


def folder(spark: SparkSession) -> str:
    """A new path under spark.checkpoint.dir, or under a temporary folder where that is unset and all tasks run on this machine; removed when the process ends."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
        if not _local:
            _local.append("file://" + tempfile.mkdtemp(prefix="tidemark-"))
        top = _local[0]
    _made.append((spark, f"{top.rstrip('/')}/tables-{uuid.uuid4().hex}"))
    return _made[-1][1]


@atexit.register
def _remove() -> None:
    for spark, path in _made:
        try:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
        except Exception:  # the session has ended
            pass
