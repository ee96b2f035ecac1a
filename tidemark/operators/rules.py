"""Data-quality rules as data: a code and a predicate; tagging and splitting by them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """The code of what is wrong and a SQL predicate that is true where it is. A predicate that is null counts as false."""

    code: str
    wrong: str


def blank(name: str) -> str:
    """SQL: null or nothing but spaces."""
    return f"({name} IS NULL OR trim({name}) = '')"


def not_in(name: str, values: Sequence[str]) -> str:
    return f"({name} IS NULL OR {name} NOT IN ({', '.join(repr(v) for v in values)}))"


def codes(rules: Sequence[Rule]) -> Column:
    """The codes of the rules a row breaks, in the rules' order."""
    return F.array_compact(F.array(*(F.when(F.expr(r.wrong), r.code) for r in rules)).cast("array<string>"))


def tag(df: DataFrame, always: Sequence[Rule], unless_deleted: Sequence[Rule] = (), operation: str = "cdc_operation", out: str = "dq_errors") -> DataFrame:
    """Adds the broken rules' codes. Deletes need only keep the rules of ``always``; a row without an operation has to keep all."""
    found = codes(always)
    if unless_deleted:
        found = F.when(F.col(operation) == "d", found).otherwise(codes([*always, *unless_deleted]))
    return df.withColumn(out, found)


def valid(tagged: DataFrame, errors: str = "dq_errors") -> DataFrame:
    return tagged.where(F.size(errors) == 0).drop(errors)


def quarantine(tagged: DataFrame, errors: str = "dq_errors") -> DataFrame:
    wrong = tagged.where(F.size(errors) > 0)
    return wrong.withColumns({"dq_error_count": F.size(errors), "quarantined_at": F.current_timestamp()})


def drop_repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Without any row of a key that several rows have. Rows with a null key stay."""
    return df.join(repeated_keys(df, key).select(key), key, "left_anti").select(*df.columns)


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).count().where("count > 1")
