"""The state that the change log implies at each cutoff, carried from cutoff to cutoff."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import state
from tidemark.store import MergeCounts, VersionedTable


@dataclass(frozen=True)
class Advance:
    """How a state came to its cutoff. previous and counts are None for the first one."""

    state: DataFrame
    previous: str | None
    counts: MergeCounts | None
    processed: int | None


def write_state(table: VersionedTable, df: DataFrame, key: str, first: bool) -> MergeCounts | None:
    """Overwrites on the first run, else merges: an update or insert for any operation but a delete."""
    if first:
        table.overwrite(df)
        return None
    held = df.persist()
    try:
        return table.merge(held, [key], update="s.cdc_operation <> 'd'", delete="s.cdc_operation = 'd'", insert="s.cdc_operation <> 'd'")
    finally:
        held.unpersist()


def metadata_row(current: DataFrame, entity: str, as_of: str, run_id: str, advance: Advance) -> DataFrame:
    """The log entry of an advance. On the first run the processed rows are by definition the state's rows.

    An incremental run needs the previous cutoff, the merge's counts and the number of events."""
    first = advance.previous is None and advance.counts is None and advance.processed is None
    if not first and (advance.previous is None or advance.counts is None or advance.processed is None):
        raise ValueError("an incremental run needs previous, counts and processed")
    rows = F.col("state_row_count")
    c = advance.counts
    long = lambda v: F.lit(v).cast("long")
    return current.agg(F.count("*").alias("state_row_count")).select(
        rows,
        F.lit(entity).alias("entity_name"),
        F.lit(advance.previous).cast("timestamp").alias("previous_state_as_of"),
        F.lit(as_of).cast("timestamp").alias("state_as_of"),
        (rows if first else long(c.num_inserted_rows)).alias("records_inserted"),
        (long(0) if first else long(c.num_updated_rows)).alias("records_updated"),
        (long(0) if first else long(c.num_deleted_rows)).alias("records_deleted"),
        (rows if first else long(advance.processed)).alias("processed_cdc_rows"),
        F.lit(run_id).alias("reconciliation_run_id"),
        F.current_timestamp().alias("processed_at"),
    )


def advance(history: DataFrame, table: VersionedTable, metadata: VersionedTable, key: str, entity: str, as_of: str, run_id: str) -> Advance:
    """Brings the expected state to the cutoff: from all history the first time, later from the events since the last cutoff only.

    The last cutoff comes from the state's own metadata and is fetched first, so that the interval is a literal range at the scan."""
    if not table.exists():
        write_state(table, state.latest_as_of(history, as_of, key), key, first=True)
        done = Advance(table.read(), None, None, None)
    else:
        last = state.high_water_mark(metadata.read()).select(F.date_format("state_as_of", "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]
        changes = state.interval(history, last, as_of)
        counts = write_state(table, state.latest_of_interval(changes, key, as_of), key, first=False)
        done = Advance(table.read(), last, counts, changes.count())
    metadata.append(metadata_row(done.state, entity, as_of, run_id, done))
    return done
