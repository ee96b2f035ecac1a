"""One micro-batch from raw records to the four curated tables of an entity."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.entities import EntitySpec
from tidemark.operators import ordering, rules
from tidemark.platform.log import get_logger
from tidemark.sources import envelope
from tidemark.store import MergeCounts, VersionedTable

log = get_logger("silver")
#: Parts of a canonical table by its key, so that a batch rewrites only what it touches.
CANONICAL_BUCKETS = 64


@dataclass(frozen=True)
class SilverTables:
    """latest holds the last accepted event of each key, deletes included, so that a batch need not read history for it."""

    quarantine: VersionedTable
    history: VersionedTable
    canonical: VersionedTable
    rejected: VersionedTable
    latest: VersionedTable

    @classmethod
    def at(cls, spark, where: Callable[[str], str], key: str, buckets: int = CANONICAL_BUCKETS) -> SilverTables:
        """where: the path of each dataset by its name."""
        plain = lambda name: VersionedTable(spark, where(name))
        keyed = lambda name: VersionedTable(spark, where(name), (key,), buckets)
        return cls(plain("quarantine"), plain("cdc_history"), keyed("canonical"), plain("rejected"), keyed("cdc_latest"))

    def compact(self) -> None:
        for table in (self.quarantine, self.history, self.canonical, self.rejected, self.latest):
            if table.exists():
                table.compact()


def events(bronze: DataFrame, spec: EntitySpec) -> DataFrame:
    """Typed events of raw records, tombstones left out."""
    parsed = envelope.parse(envelope.without_tombstones(bronze), spec.record_schema)
    return envelope.normalise(envelope.effective_record(parsed, "record"), "record", spec.event_columns)


def tagged(found: DataFrame, spec: EntitySpec) -> DataFrame:
    return rules.tag(found, spec.cdc_rules, spec.business_rules)


def write_events(table: VersionedTable, df: DataFrame) -> int:
    """Adds the events that the table doesn't hold, by identity."""
    return table.insert_absent(df, ordering.IDENTITY, within="kafka_offset")


def advance_latest(table: VersionedTable, accepted: DataFrame, key: str) -> None:
    """Brings the last event of each of the batch's keys up to date. Replays of older events change nothing, so it can be repeated."""
    last = ordering.latest_per_key(accepted, key).persist()
    try:
        table.merge(last, [key], update="s.source_lsn > t.source_lsn OR (s.source_lsn = t.source_lsn AND s.kafka_offset > t.kafka_offset)", insert="true")
    finally:
        last.unpersist()


def apply_canonical(table: VersionedTable, accepted: DataFrame, key: str, known: DataFrame | None = None) -> MergeCounts:
    """Upserts or deletes by the last event of each key.

    With ``known``, accepted events of these keys that hold the batch's already (all history, or just the last event of each key), that is the key's last event there: a replay of an old event
    then cannot undo a newer one or bring a deleted key back. Without it the batch's own last event decides."""
    source = accepted if known is None else known.join(accepted.select(key).distinct(), key, "left_semi").select(*accepted.columns)
    last = ordering.latest_per_key(source, key).persist()
    try:
        return table.merge(last, [key], update="s.cdc_operation IN ('c', 'u', 'r')", delete="s.cdc_operation = 'd'", insert="s.cdc_operation <> 'd'")
    finally:
        last.unpersist()


def process_batch(bronze: DataFrame, spec: EntitySpec, tables: SilverTables, batch_id: int | None = None, strict_parity: bool = False) -> dict[str, int]:
    """Parses, checks, orders and writes one batch: quarantine, history, latest, canonical, rejected, in this order. Every write can be
    repeated, so a batch that broke off is simply run again.

    What is accepted is settled before history changes, since it is judged against earlier history. strict_parity: the batch's last
    event decides the canonical row, even if it is a replay of an old one."""
    began, held = time.monotonic(), []
    keep = lambda df: held.append(df.persist()) or held[-1]
    log.info(f"{spec.name}_silver_batch_started", batch_id=batch_id)
    try:
        seen = keep(tagged(events(bronze, spec), spec))
        split = ordering.split_same_run(rules.valid(seen), spec.key)
        before = last = None
        if tables.history.exists():
            if not tables.latest.exists():
                advance_latest(tables.latest, tables.history.read(), spec.key)
            # replays have offsets of the batch's range, and its keys lie in some buckets of latest
            before = tables.history.read_within("kafka_offset", *seen.agg(F.min("kafka_offset"), F.max("kafka_offset")).first())
            last = tables.latest.read_for(seen)
        found = ordering.classify(split, before, spec.key, last)
        accepted, rejected = keep(found.accepted), keep(found.rejected)
        counts = {"accepted": accepted.count(), "rejected": rejected.count()}
        counts["quarantined"] = write_events(tables.quarantine, rules.quarantine(seen))
        write_events(tables.history, accepted)
        advance_latest(tables.latest, accepted, spec.key)
        apply_canonical(tables.canonical, accepted, spec.key, None if strict_parity else tables.latest.read_for(accepted))
        write_events(tables.rejected, rejected)
    except Exception:
        log.error(f"{spec.name}_silver_batch_failed", batch_id=batch_id, duration_seconds=round(time.monotonic() - began, 3))
        raise
    finally:
        for df in held:
            df.unpersist()
    log.info(f"{spec.name}_silver_batch_completed", batch_id=batch_id, duration_seconds=round(time.monotonic() - began, 3), **counts)
    return counts


def quarantine_counts(table: VersionedTable) -> DataFrame:
    """How often each code was found."""
    return table.read().select(F.explode("dq_errors").alias("code")).groupBy("code").count()
