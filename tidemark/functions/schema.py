"""Schemas from short texts, without a session."""

from __future__ import annotations

from pyspark.sql.types import BooleanType, DataType, DateType, IntegerType, LongType, StringType, StructField, StructType, TimestampType

TYPES: dict[str, type[DataType]] = {"bigint": LongType, "int": IntegerType, "string": StringType, "boolean": BooleanType, "date": DateType, "timestamp": TimestampType}


def struct(columns: str) -> StructType:
    """Nullable columns of plain types, as in ``a bigint, b string``."""
    pairs = (c.split() for c in columns.split(","))
    return StructType([StructField(name, TYPES[kind](), True) for name, kind in pairs])
