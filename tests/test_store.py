"""Versioned tables."""

from __future__ import annotations

import pytest

from tidemark import store
from tidemark.store import CommitConflict, DuplicateSourceKey, MergeCounts, VersionedTable


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), "k long, v string, op string")


def values(df):
    return sorted((r["k"], r["v"]) for r in df.collect())


CLAUSES = {"update": "s.op <> 'd'", "delete": "s.op = 'd'", "insert": "s.op <> 'd'"}


@pytest.mark.parametrize("buckets", [0, 4])
def test_merge(spark, tmp_path, buckets):
    t = VersionedTable(spark, f"file://{tmp_path}/t", ("k",), buckets)
    assert not t.exists()
    assert t.merge(frame(spark, (1, "a", "u"), (2, "b", "u"), (3, "c", "d")), ["k"], **CLAUSES) == MergeCounts(2, 0, 0)
    old = t.read()
    assert t.merge(frame(spark, (1, "A", "u"), (2, "b", "d"), (4, "d", "u"), (5, "e", "d")), ["k"], **CLAUSES) == MergeCounts(1, 1, 1)
    assert values(t.read()) == [(1, "A"), (4, "d")]
    assert values(old) == [(1, "a"), (2, "b")] == values(t.read(1))
    assert t.merge(frame(spark, (9, "x", "d")), ["k"], **CLAUSES) == MergeCounts(0, 0, 0)


def test_a_merge_leaves_untouched_buckets_alone(spark, tmp_path):
    t = VersionedTable(spark, f"file://{tmp_path}/t", ("k",), 8)
    t.merge(frame(spark, *((k, "a", "u") for k in range(40))), ["k"], **CLAUSES)
    before = {p["path"] for p in t.manifest().parts}
    t.merge(frame(spark, (7, "b", "u")), ["k"], **CLAUSES)
    assert len(before & {p["path"] for p in t.manifest().parts}) == len(before) - 1
    assert dict(values(t.read()))[7] == "b" and t.read().count() == 40


def test_repeated_source_keys_are_an_error_and_null_keys_never_match(spark, tmp_path):
    t = VersionedTable(spark, f"file://{tmp_path}/t")
    t.overwrite(frame(spark, (None, "n", "u"), (1, "a", "u")))
    with pytest.raises(DuplicateSourceKey):
        t.merge(frame(spark, (1, "x", "u"), (1, "y", "u")), ["k"], **CLAUSES)
    assert t.merge(frame(spark, (None, "m", "u"), (None, "o", "u")), ["k"], **CLAUSES).num_inserted_rows == 2
    assert t.insert_absent(frame(spark, (1, "z", "u"), (None, "q", "u")), ["k"]) == 1
    assert t.insert_absent(frame(spark, (1, "z", "u"), (8, "q", "u")), ["k"], within="k") == 1
    assert t.insert_absent(frame(spark, (None, "z", "u")), ["k"], within="k") == 1


def test_appends_copy_nothing_and_one_writer_wins(spark, tmp_path):
    t, u = (VersionedTable(spark, f"file://{tmp_path}/t") for _ in range(2))
    t.append(frame(spark, (1, "a", "u")))
    first = t.manifest().parts
    t.append(frame(spark, (2, "b", "u")))
    assert t.manifest().parts[:1] == first and t.read().count() == 2
    with pytest.raises(CommitConflict):
        u._commit(t.manifest(1), t.read().schema, 0, [])
    assert t.versions() == [1, 2]


def test_parts_without_a_manifest_are_not_read(spark, tmp_path):
    t = VersionedTable(spark, f"file://{tmp_path}/t")
    t.append(frame(spark, (1, "a", "u")))
    t._write(frame(spark, (2, "b", "u")), 0)  # a writer that died before its commit
    assert t.read().count() == 1


def test_versions_are_read_through_their_changes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "CHECKPOINT", 3)
    t = VersionedTable(spark, f"file://{tmp_path}/t", ("k",), 2)
    for v in range(1, 6):
        t.merge(frame(spark, (v, "a", "u"), (1, f"v{v}", "u")) if v > 1 else frame(spark, (1, "v1", "u")), ["k"], **CLAUSES)
        assert len(t.versions()) == v
    for v in range(1, 6):
        assert values(t.read(v)) == [(1, f"v{v}"), *((k, "a") for k in range(2, v + 1))]
    assert [t._load(v)["full"] for v in range(1, 6)] == [True, False, False, True, False]


def test_upkeep(spark, tmp_path):
    t = VersionedTable(spark, f"file://{tmp_path}/t", ("k",), 2)
    for k in range(6):
        t.append(frame(spark, (k, "a", "u"), (k + 100, "b", "u")), {"k": [k, k + 100]})
    rows = values(t.read())
    assert t.compact(small_parts=100) == 0 and t.compact(bucket_rows=3, small_parts=3) > 0
    m = t.manifest()
    assert m.key_buckets == 4 and len(m.parts) <= 4 and all(p["known"] == {"k": [0, 105]} for p in m.parts) and values(t.read()) == rows
    # the number of buckets comes from the table, not from who opens it
    u = VersionedTable(spark, f"file://{tmp_path}/t", ("k",), 2)
    assert u.merge(frame(spark, (3, "c", "u")), ["k"], **CLAUSES).num_updated_rows == 1 and dict(values(u.read()))[3] == "c"
    assert u.vacuum() > 0 and dict(values(u.read()))[3] == "c" and u.vacuum() == 0
    plain = VersionedTable(spark, f"file://{tmp_path}/p")
    for k in range(4):
        plain.append(frame(spark, (k, "a", "u")))
    assert plain.compact(small_parts=2) == 4 and values(plain.read()) == [(k, "a") for k in range(4)]
    plain.save_as("plain_copy", f"file://{tmp_path}/c")
    assert values(spark.table("plain_copy")) == [(k, "a") for k in range(4)]
    spark.sql("DROP TABLE plain_copy")


def files(df):
    return {f.rpartition("/t/")[2].split("/")[0] for f in df.inputFiles()}


def test_a_range_opens_only_its_parts(spark, tmp_path):
    t = VersionedTable(spark, f"file://{tmp_path}/t")
    for k in range(5):
        t.insert_absent(frame(spark, *((10 * k + i, "a", "u") for i in range(5))), ["k"], within="k")
    assert len(files(t.read())) == 5 and len(files(t.read_within("k", 12, 23))) == 2
    assert values(t.read_within("k", 12, 23)) == [(k, "a") for k in (12, 13, 14, 20, 21, 22, 23)]
    assert t.read_within("k", None, None).count() == 0
