"""Replays, ambiguity, classification, canonical state."""

from __future__ import annotations

import random

import pytest

from tidemark.operators import ordering
from tidemark.plans import silver
from tidemark.store import VersionedTable

SCHEMA = "customer_id long, first_name string, cdc_operation string, source_lsn long, kafka_topic string, kafka_partition int, kafka_offset long"
KEY = "customer_id"


def events(spark, *rows):
    """(key, lsn, partition, offset, operation, name)"""
    full = [(k, r[0] if r else "n", op, lsn, "t", p, o) for k, lsn, p, o, op, *r in rows]
    return spark.createDataFrame(full, SCHEMA)


def places(df):
    return {(r["customer_id"], r["kafka_partition"], r["kafka_offset"]) for r in df.collect()}


def test_exact_replay_counts_once(spark):
    split = ordering.split_same_run(events(spark, (1, 100, 0, 10, "u"), (1, 100, 0, 10, "u")), KEY)
    assert split.orderable.count() == 1 and split.ambiguous.count() == 0


def test_one_lsn_over_two_partitions_is_ambiguous(spark):
    split = ordering.split_same_run(events(spark, (1, 100, 0, 10, "u"), (1, 100, 1, 11, "u"), (2, 100, 0, 12, "u")), KEY)
    assert places(split.orderable) == {(2, 0, 12)}
    rows = split.ambiguous.collect()
    assert len(rows) == 2 and all(r["cdc_status"] == "AMBIGUOUS_ORDERING" and r["persisted_source_lsn"] is None for r in rows)


def test_same_partition_tie_is_ordered_by_offset(spark):
    split = ordering.split_same_run(events(spark, (1, 100, 0, 10, "u"), (1, 100, 0, 11, "u")), KEY)
    assert places(ordering.latest_per_key(split.orderable, KEY)) == {(1, 0, 11)}


def test_all_kinds_against_history(spark):
    history = events(spark, (1, 100, 0, 10, "u"))
    batch = events(spark, (2, 110, 0, 20, "c"), (1, 120, 0, 21, "u"), (1, 90, 0, 22, "u"), (1, 100, 0, 10, "u"), (1, 100, 1, 23, "u"))
    found = ordering.classify(ordering.Split(batch, ordering.split_same_run(batch.limit(0), KEY).ambiguous), history, KEY)
    assert places(found.accepted) == {(2, 0, 20), (1, 0, 21), (1, 0, 10)}
    assert {(r["kafka_offset"], r["cdc_status"], r["persisted_kafka_offset"]) for r in found.rejected.collect()} == {(22, "STALE", 10), (23, "AMBIGUOUS_ORDERING", 10)}


def test_first_run_accepts_all_that_can_be_ordered(spark):
    split = ordering.split_same_run(events(spark, (1, 5, 0, 1, "u"), (1, 4, 0, 2, "u")), KEY)
    found = ordering.classify(split, None, KEY)
    assert found.accepted.count() == 2 and found.rejected.count() == 0


def test_canonical_from_insert_to_delete(spark, tmp_path):
    table, seen = VersionedTable(spark, f"file://{tmp_path}/c", (KEY,), 4), []
    for batch in ((1, 100, 0, 1, "c", "a"), (1, 200, 0, 2, "u", "b"), (1, 200, 0, 2, "u", "b"), (1, 300, 0, 3, "d", "b")):
        silver.apply_canonical(table, events(spark, batch), KEY)
        seen.append([r["first_name"] for r in table.read().collect()])
    assert seen == [["a"], ["b"], ["b"], []]


def test_delete_of_an_unknown_key_adds_nothing(spark, tmp_path):
    table = VersionedTable(spark, f"file://{tmp_path}/c", (KEY,), 4)
    silver.apply_canonical(table, events(spark, (1, 1, 0, 1, "u"), (1, 2, 0, 2, "u"), (2, 3, 0, 3, "d"), (3, 4, 0, 4, "c"), (3, 5, 0, 5, "d")), KEY)
    assert places(table.read()) == {(1, 0, 2)}


@pytest.mark.parametrize(("strict", "offset"), [(False, 2), (True, 1)])
def test_a_replay_of_an_old_event_undoes_nothing_unless_asked(spark, tmp_path, strict, offset):
    table, history = VersionedTable(spark, f"file://{tmp_path}/c", (KEY,), 4), events(spark, (1, 100, 0, 1, "c"), (1, 200, 0, 2, "u"))
    silver.apply_canonical(table, history, KEY)
    silver.apply_canonical(table, events(spark, (1, 100, 0, 1, "c")), KEY, None if strict else history)
    assert places(table.read()) == {(1, 0, offset)}


def test_any_split_of_an_ordered_log_gives_one_state(spark, tmp_path):
    rng = random.Random(3)
    log = [(rng.randrange(6), lsn, 0, lsn, rng.choice("cuurd"), f"n{lsn}") for lsn in range(40)]
    states = []
    for n, cuts in enumerate(([40], [13, 40])):
        table, history, at = VersionedTable(spark, f"file://{tmp_path}/c{n}", (KEY,), 4), VersionedTable(spark, f"file://{tmp_path}/h{n}"), 0
        for cut in cuts:
            batch = events(spark, *log[max(0, at - 3) : cut])  # with some replays
            found = ordering.classify(ordering.split_same_run(batch, KEY), history.read() if history.exists() else None, KEY)
            accepted = found.accepted.persist()
            accepted.count()
            silver.write_events(history, accepted)
            silver.apply_canonical(table, accepted, KEY, history.read())
            at = cut
        states.append(places(table.read()))
    assert states[0] == states[1]
