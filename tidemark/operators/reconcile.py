"""Comparison of an authoritative snapshot with the state from the change log: buckets, then rows, then fields.

Only rows of buckets that differ are joined, so two sides that agree cost one aggregation each.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: the text for null, states of rows and of runs
NULL_TEXT = "__NULL__"
AGREED, DISAGREED = "SUCCESS", "COMPLETED_WITH_EXCEPTIONS"
#: Rows that a bucket should hold: so many are joined for a single difference.
BUCKET_ROWS = 10_000
ROW_STATES = ("MISSING_IN_CDC", "MISSING_IN_SNAPSHOT", "CHECKSUM_MISMATCH")


def row_checksum(normalised: Sequence[str]) -> Column:
    """SHA-256 of the normalised values, null as a text of its own. Columns are SQL expressions that give strings."""
    return F.sha2(F.concat_ws("||", *(F.coalesce(F.expr(e), F.lit(NULL_TEXT)) for e in normalised)), 256)


def bucket_count(rows: int, least: int) -> int:
    """The set number of buckets, or as many as the rows ask for."""
    return max(least, -(-rows // BUCKET_ROWS))


def bucket_of(key: str, buckets: int, by_value: bool = False) -> Column:
    """1 to buckets. by_value: by the number itself rather than a hash of it."""
    return F.pmod(F.col(key) if by_value else F.hash(key), F.lit(buckets)).cast("int") + 1


def checksums(df: DataFrame, key: str, normalised: Sequence[str], buckets: int, side: str, by_value: bool = False) -> DataFrame:
    """The rows with bucket_id and ``<side>_row_checksum``."""
    return df.withColumns({"bucket_id": bucket_of(key, buckets, by_value), f"{side}_row_checksum": row_checksum(normalised)})


def bucket_digests(rows: DataFrame, key: str, side: str, as_text: bool = False) -> DataFrame:
    """(bucket_id, count, digest). The digest is free of order and sums up row by row, so a bucket of any size is one small
    aggregate; ``as_text`` gives the hash of the sorted row checksums instead, which gathers each bucket."""
    h = F.col(f"{side}_row_checksum")
    if as_text:
        digest = F.sha2(F.concat_ws("||", F.sort_array(F.collect_list(h))), 256)
    else:
        slices = (F.conv(F.substring(h, at, 15), 16, 10).cast("decimal(38,0)") for at in (1, 16, 31, 46))
        digest = F.concat_ws(":", *(F.sum(x).cast("string") for x in slices))
    return rows.groupBy("bucket_id").agg(F.count(key).alias(f"{side}_row_count"), digest.alias(f"{side}_checksum"))


def compare_buckets(snapshot: DataFrame, cdc: DataFrame, key: str, as_text: bool = False) -> DataFrame:
    both = bucket_digests(snapshot, key, "snapshot", as_text).join(bucket_digests(cdc, key, "cdc", as_text), "bucket_id", "full_outer")
    status = F.expr(
        """CASE WHEN snapshot_row_count IS NULL THEN 'MISSING_IN_SNAPSHOT' WHEN cdc_row_count IS NULL THEN 'MISSING_IN_CDC'
                WHEN snapshot_row_count <> cdc_row_count THEN 'COUNT_MISMATCH'
                WHEN snapshot_checksum <> cdc_checksum THEN 'CHECKSUM_MISMATCH' ELSE 'MATCH' END"""
    )
    return both.withColumn("reconciliation_status", status)


def row_status() -> Column:
    return F.expr(
        """CASE WHEN snapshot_present IS NULL THEN 'MISSING_IN_SNAPSHOT' WHEN cdc_present IS NULL THEN 'MISSING_IN_CDC'
                WHEN snapshot_row_checksum <> cdc_row_checksum THEN 'CHECKSUM_MISMATCH' ELSE 'MATCH' END"""
    )


def differing_fields(columns: Sequence[str]) -> Column:
    """``<COLUMN>_MISMATCH`` of every compared column whose raw values differ."""
    return F.array_compact(F.array(*(F.when(~F.col(f"snapshot_{c}").eqNullSafe(F.col(f"cdc_{c}")), f"{c.upper()}_MISMATCH") for c in columns)).cast("array<string>"))


def compare_rows(snapshot: DataFrame, cdc: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Every row of either side with presence, checksums, status and both sides' values."""

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(key, f"{name}_row_checksum", F.lit(True).alias(f"{name}_present"), *(F.col(c).alias(f"{name}_{c}") for c in columns))

    both = side(snapshot, "snapshot").join(side(cdc, "cdc"), key, "full_outer")
    order = [key, "snapshot_row_checksum", "cdc_row_checksum", "snapshot_present", "cdc_present", "reconciliation_status"]
    return both.withColumn("reconciliation_status", row_status()).select(*order, *(f"snapshot_{c}" for c in columns), *(f"cdc_{c}" for c in columns))


def exceptions(snapshot: DataFrame, state: DataFrame, key: str, normalised: Sequence[str] | Mapping[str, Sequence[str]], columns: Sequence[str], buckets: int, as_text: bool = False) -> DataFrame:
    """The rows that disagree, with mismatch_columns (empty where a side is missing). The result doesn't depend on ``buckets``.

    normalised: for both sides, or by side under 'snapshot' and 'cdc'."""
    of = normalised if isinstance(normalised, Mapping) else {"snapshot": normalised, "cdc": normalised}
    left, right = checksums(snapshot, key, of["snapshot"], buckets, "snapshot"), checksums(state, key, of["cdc"], buckets, "cdc")
    differ = compare_buckets(left, right, key, as_text).where("reconciliation_status <> 'MATCH'").select("bucket_id")
    rows = compare_rows(left.join(differ, "bucket_id", "left_semi"), right.join(differ, "bucket_id", "left_semi"), key, columns)
    wrong = rows.where("reconciliation_status <> 'MATCH'")
    fields = F.when(F.col("reconciliation_status") == "CHECKSUM_MISMATCH", differing_fields(columns)).otherwise(F.array().cast("array<string>"))
    return wrong.withColumn("mismatch_columns", fields)


def with_run(df: DataFrame, as_of: str, entity: str, run_id: str) -> DataFrame:
    return df.withColumns({"reconciliation_run_id": F.lit(run_id), "snapshot_as_of": F.lit(as_of).cast("timestamp"), "reconciled_at": F.current_timestamp(), "entity_name": F.lit(entity)})


def run_summary(snapshot: DataFrame, state: DataFrame, found: DataFrame, run_id: str, as_of: str, entity: str) -> DataFrame:
    """One row of counts from one pass over what was compared and what was found."""
    seen = snapshot.select(F.lit("SNAPSHOT").alias("what")).unionAll(state.select(F.lit("CDC"))).unionAll(found.select("reconciliation_status"))
    number = lambda *kinds: F.count_if(F.col("what").isin(*kinds))
    columns = {"snapshot_row_count": number("SNAPSHOT"), "cdc_row_count": number("CDC"), "exception_count": number(*ROW_STATES)}
    columns |= {f"{s.lower()}_count": number(s) for s in ROW_STATES}
    # rows of the snapshot that are neither missing on the other side nor different there
    columns["matched_row_count"] = number("SNAPSHOT") - number("MISSING_IN_CDC", "CHECKSUM_MISMATCH")
    columns["overall_status"] = F.when(number(*ROW_STATES) == 0, AGREED).otherwise(DISAGREED)
    row = seen.agg(*(c.alias(name) for name, c in columns.items()))
    return with_run(row, as_of, entity, run_id)
