"""Snapshot against state: independence of buckets, sums, runs, advances."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidemark.entities import CONSENTS
from tidemark.operators import reconcile, state
from tidemark.plans import expected_state
from tidemark.plans.reconciliation import ReconciliationTables, reconcile_snapshot
from tidemark.store import VersionedTable

LOG = "consent_id long, customer_id long, consent_type string, granted boolean, updated_at timestamp, source_lsn long, kafka_topic string, kafka_partition int, kafka_offset long, cdc_operation string, source_timestamp timestamp, ingested_at timestamp"


def log(spark, rows):
    """(key, lsn, operation, minute, granted)"""
    full = [(k, 1, "EMAIL", g, "2024-01-01 00:00:00", lsn, "t", 0, lsn, op, f"2024-01-01 00:{m:02d}:00", "2024-01-02 00:00:00") for k, lsn, op, m, g in rows]
    text = LOG.replace("timestamp timestamp", "timestamp string").replace("_at timestamp", "_at string")
    df = spark.createDataFrame(full, text)
    return df.withColumns({c: F.col(c).cast("timestamp") for c in ("updated_at", "source_timestamp", "ingested_at")})


def pair(spark):
    rng = random.Random(5)
    left = [(k, rng.choice(["a", "A ", None]), rng.randrange(3)) for k in range(120) if k % 7]
    right = [(k, v if k % 11 else "z", n) for k, v, n in left if k % 13] + [(k, "q", 1) for k in range(200, 205)]
    return (spark.createDataFrame(rows, "k long, v string, n long") for rows in (left, right))


SUMS = ("CAST(k AS STRING)", "lower(trim(v))", "CAST(n AS STRING)")


@pytest.mark.parametrize(("buckets", "as_text"), [(1, False), (5, True), (97, False)])
def test_exceptions_do_not_depend_on_buckets(spark, buckets, as_text):
    snap, st = pair(spark)
    found = reconcile.exceptions(snap, st, "k", SUMS, ("v", "n"), buckets, as_text)
    a, b = ({r["k"]: r for r in df.collect()} for df in (snap, st))
    norm = lambda r: ((r["v"] or "__NULL__").strip().lower(), r["n"])
    want = {k: "MISSING_IN_CDC" if k not in b else "MISSING_IN_SNAPSHOT" if k not in a else "CHECKSUM_MISMATCH" for k in {*a, *b} if k not in a or k not in b or norm(a[k]) != norm(b[k])}
    assert {r["k"]: r["reconciliation_status"] for r in found.collect()} == want
    s = reconcile.run_summary(snap, st, found, "r", "2024-01-01 00:00:00", "e").first()
    assert s["snapshot_row_count"] == s["matched_row_count"] + s["missing_in_cdc_count"] + s["checksum_mismatch_count"]
    assert s["exception_count"] == s["missing_in_cdc_count"] + s["missing_in_snapshot_count"] + s["checksum_mismatch_count"] == len(want)


def test_fields_differ_by_raw_value(spark):
    a = spark.createDataFrame([(1, "x ", 1)], "k long, v string, n long")
    b = spark.createDataFrame([(1, "X", 2)], "k long, v string, n long")
    assert reconcile.exceptions(a, b, "k", SUMS, ("v", "n"), 4).first()["mismatch_columns"] == ["V_MISMATCH", "N_MISMATCH"]


def test_five_events_make_one_insert_two_updates_one_delete(spark, tmp_path):
    rows = [(1, 1, "c", 1, True), (2, 2, "c", 1, True), (3, 3, "c", 1, True), (1, 4, "u", 11, False), (1, 5, "u", 12, True), (2, 6, "u", 12, False), (3, 7, "d", 13, True), (4, 8, "c", 14, True)]
    table, meta = (VersionedTable(spark, f"file://{tmp_path}/{n}") for n in "tm")
    expected_state.advance(log(spark, rows), table, meta, "consent_id", "e", "2024-01-01 00:10:00", "a")
    done = expected_state.advance(log(spark, rows), table, meta, "consent_id", "e", "2024-01-01 00:20:00", "b")
    assert (done.counts.num_inserted_rows, done.counts.num_updated_rows, done.counts.num_deleted_rows, done.processed) == (1, 2, 1, 5)
    assert {r["consent_id"] for r in done.state.collect()} == {1, 2, 4}
    again = expected_state.advance(log(spark, rows), table, meta, "consent_id", "e", "2024-01-01 00:20:00", "c")
    assert again.processed == 0 and meta.read().count() == 3


def test_cutoffs_of_an_ordered_log_lead_to_the_state_from_scratch(spark, tmp_path):
    rng = random.Random(8)
    rows = [(rng.randrange(8), lsn, rng.choice("ccuud"), lsn, bool(rng.randrange(2))) for lsn in range(1, 50)]
    table, meta = (VersionedTable(spark, f"file://{tmp_path}/{n}", *((("consent_id",), 4) if n == "t" else ())) for n in "tm")
    for at in ("00:12", "00:30", "00:55"):
        done = expected_state.advance(log(spark, rows), table, meta, "consent_id", "e", f"2024-01-01 {at}:00", at)
    fresh = state.latest_as_of(log(spark, rows), "2024-01-01 00:55:00", "consent_id")
    key = lambda df: sorted((r["consent_id"], r["source_lsn"]) for r in df.collect())
    assert key(done.state) == key(fresh)


def test_late_events_are_seen(spark):
    assert state.late_events(log(spark, [(1, 1, "c", 1, True), (2, 2, "c", 59, True)]), "2024-01-01 00:10:00").count() == 1


def test_an_incremental_entry_needs_its_inputs(spark):
    with pytest.raises(ValueError):
        expected_state.metadata_row(spark.range(1), "e", "2024-01-01 00:00:00", "r", expected_state.Advance(spark.range(1), "2024-01-01 00:00:00", None, None))


def test_a_run_is_recorded_and_may_be_repeated(spark, tmp_path):
    at = lambda n: VersionedTable(spark, f"file://{tmp_path}/{n}")
    tables = ReconciliationTables(*(at(n) for n in ("h", "e", "m", "s", "d")))
    tables.history.append(log(spark, [(1, 1, "c", 1, True), (2, 2, "c", 1, True), (3, 3, "c", 1, True)]))
    snap = spark.createDataFrame([(1, 1, "email ", True), (2, 1, "EMAIL", False), (9, 1, "EMAIL", True)], "consent_id long, customer_id long, consent_type string, granted boolean")
    snap = snap.withColumn("updated_at", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    for run in ("a", "b"):
        s = reconcile_snapshot(snap, CONSENTS, tables, "2024-01-01 00:10:00", 4, run)
        assert (s["snapshot_row_count"], s["cdc_row_count"], s["exception_count"], s["matched_row_count"], s["overall_status"]) == (3, 3, 3, 1, "COMPLETED_WITH_EXCEPTIONS")
    assert tables.detail.read().count() == 6 and tables.summary.read().count() == 2
    with pytest.raises(ValueError):
        reconcile_snapshot(snap, CONSENTS, tables, "", 4)
