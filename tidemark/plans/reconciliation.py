"""A reconciliation run: snapshot against expected state, with its record."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession

from tidemark.entities import EntitySpec
from tidemark.operators import reconcile
from tidemark.plans import expected_state
from tidemark.platform.log import get_logger
from tidemark.platform.paths import Layout
from tidemark.platform.session import start
from tidemark.sources import snapshots
from tidemark.store import VersionedTable

log = get_logger("reconciliation")
DOMAIN = "customer"


@dataclass(frozen=True)
class ReconciliationTables:
    history: VersionedTable
    expected: VersionedTable
    metadata: VersionedTable
    summary: VersionedTable
    detail: VersionedTable

    @classmethod
    def of(cls, spark: SparkSession, layout: Layout, spec: EntitySpec) -> ReconciliationTables:
        at = lambda name, **how: VersionedTable(spark, layout.at("reconciliation", domain=DOMAIN, entity=spec.name, dataset=name), **how)
        history = VersionedTable(spark, layout.at("silver_job", domain=DOMAIN, entity=spec.name, dataset="cdc_history"))
        return cls(history, at("expected_state", key=(spec.key,), key_buckets=64), at("expected_state_metadata"), at("run_summary"), at("exception_detail"))


def reconcile_snapshot(snapshot: DataFrame, spec: EntitySpec, tables: ReconciliationTables, as_of: str, buckets: int, run_id: str | None = None) -> Row:
    """Runs one comparison and records it: exceptions first, then the summary, which is returned. snapshot: rows as loaded, without metadata.

    A cutoff may be compared again: the interval is then empty and the run gets records of its own."""
    if not as_of:
        raise ValueError("a cutoff is needed")
    run_id, began = run_id or str(uuid.uuid4()), time.monotonic()
    log.info("reconciliation_started", entity=spec.name, run_id=run_id, snapshot_as_of=as_of)
    try:
        good, _ = snapshots.validated(snapshots.with_metadata(snapshot, spec.name, as_of), spec, as_of)
        done = expected_state.advance(tables.history.read(), tables.expected, tables.metadata, spec.key, spec.name, as_of, run_id)
        rows = tables.metadata.read().where(f"reconciliation_run_id = '{run_id}'").agg({"state_row_count": "max"}).first()[0]
        wrong = reconcile.exceptions(good, done.state, spec.key, spec.checksum, spec.compare, reconcile.bucket_count(rows, buckets))
        # the written rows are counted, rather than the comparison run again
        tables.detail.append(reconcile.with_run(wrong, as_of, spec.name, run_id))
        mine = tables.detail.read().where(f"reconciliation_run_id = '{run_id}'")
        tables.summary.append(reconcile.run_summary(good, done.state, mine, run_id, as_of, spec.name))
        summary = tables.summary.read().where(f"reconciliation_run_id = '{run_id}'").first()
    except Exception:
        log.error("reconciliation_failed", entity=spec.name, run_id=run_id, duration_seconds=round(time.monotonic() - began, 3))
        raise
    log.info("reconciliation_completed", entity=spec.name, run_id=run_id, duration_seconds=round(time.monotonic() - began, 3), **{k: v for k, v in summary.asDict().items() if k.endswith(("_count", "_status"))})
    return summary


def run(spec: EntitySpec, as_of: str, environment: str = "local") -> Row:
    """The run of an entity in an environment, its snapshot read from the snapshot folder."""
    if not as_of:
        raise ValueError("a cutoff is needed")
    settings, spark = start(environment)
    layout = Layout.of(settings)
    snapshot = snapshots.load(spark, layout.at("snapshot_file", domain=spec.snapshot_folder, cutoff=as_of), spec)
    return reconcile_snapshot(snapshot, spec, ReconciliationTables.of(spark, layout, spec), as_of, settings.reconciliation.bucket_count)
