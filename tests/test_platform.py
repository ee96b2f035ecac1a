"""Settings, paths, logging, streaming restarts."""

from __future__ import annotations

import json

import pytest
import yaml
from pyspark.sql import functions as F

from tidemark import queries
from tidemark.entities import CUSTOMERS, ENTITIES
from tidemark.plans import reconciliation, silver
from tidemark.platform import errors, log
from tidemark.platform.config import get_settings, merged, project_version, section
from tidemark.platform.paths import Layout
from tidemark.sources import change_log
from tidemark.streaming import jobs


def write(root, **over):
    base = {"application": {"name": "Test"}, "spark": {"session_timezone": "UTC"}, "customer": {"customers_topic": "a", "customer_addresses_topic": "b", "customer_consents_topic": "c"}}
    env = {
        "application": {"environment": "local"}, "spark": {"master": "local[1]", "shuffle_partitions": 2, "broadcast_size_mb": 20}, "storage": {"mode": "local", "lakehouse_root": "l", "checkpoint_root": "c", "quarantine_root": "q", "snapshot_root": "s"},
        "logging": {"level": "INFO", "format": "json", "log_directory": "log"}, "kafka": {"bootstrap_servers": "x"}, "reconciliation": {"bucket_count": 4},
    }
    (root / "configs").mkdir(exist_ok=True)
    (root / "pyproject.toml").write_text('[project]\nname = "x"\nversion = "1.2.3"\n')
    (root / "configs/base.yaml").write_text(yaml.safe_dump(base))
    (root / "configs/local.yaml").write_text(yaml.safe_dump(merged(env, over)))


def test_layers_and_paths(tmp_path):
    write(tmp_path)
    s = get_settings("local", tmp_path)
    assert (s.application.name, s.application.app_version, s.storage.lakehouse_root) == ("Test", "1.2.3", tmp_path / "l")
    assert get_settings("local", f"{tmp_path}/.") is s
    paths = Layout.of(s)
    of = {"domain": "customer", "entity": "customers"}
    assert paths.at("bronze_job", **of) == f"{tmp_path}/l/bronze/customer/cdc/customers/job" and paths.at("bronze_job_checkpoint", **of) == f"{tmp_path}/c/bronze/customer/cdc/customers/job"
    assert paths.at("silver_job", dataset="canonical", **of) == f"{tmp_path}/l/silver/customer/cdc/customers/canonical/job"
    assert paths.at("snapshot_file", domain="customer", cutoff="2024-01-01 10:00:00") == f"{tmp_path}/s/customer/2024-01-01_10-00-00.csv"
    assert paths.at("reconciliation", dataset="run_summary", **of) == f"{tmp_path}/l/ops/reconciliation/customer/customers/run_summary"


def test_object_store_takes_secrets_from_outside(tmp_path, monkeypatch):
    write(tmp_path, storage={"mode": "object_store", "bucket": "b", "endpoint": "e"})
    with pytest.raises(errors.ConfigurationValidationError, match="access_key"):
        get_settings("local", tmp_path)
    (tmp_path / ".env").write_text("OBJECT_STORE_ACCESS_KEY=a\n")
    monkeypatch.setenv("OBJECT_STORE_SECRET_KEY", "k")
    s = get_settings("local", tmp_path)
    assert s.storage.access_key == "a" and s.storage.secret_key == "k" and "'k'" not in repr(s.storage)
    assert Layout.of(s).at("checkpoint", layer="silver", name="x") == "s3a://b/checkpoints/silver/x"


@pytest.mark.parametrize("over", [{"spark": {"broadcast_size_mb": 10}}, {"reconciliation": {"bucket_count": 0}}, {"kafka": {"more": 1}}, {"spark": {"shuffle_partitions": "2"}}, {"application": {"environment": "x"}}, {"logging": None}])
def test_wrong_values(tmp_path, over):
    write(tmp_path, **over)
    with pytest.raises(errors.ConfigurationValidationError):
        get_settings("local", tmp_path)


def test_wrong_files(tmp_path):
    with pytest.raises(errors.ConfigurationFileNotFoundError):
        get_settings("local", tmp_path)
    write(tmp_path)
    (tmp_path / "configs/base.yaml").write_text("- a\n")
    with pytest.raises(errors.ConfigurationParseError):
        get_settings("local", tmp_path)
    (tmp_path / "configs/base.yaml").write_text("a: [")
    with pytest.raises(errors.ConfigurationParseError):
        get_settings("local", tmp_path)
    (tmp_path / "pyproject.toml").write_text("[project]\n")
    with pytest.raises(errors.ConfigurationParseError):
        project_version(tmp_path / "pyproject.toml")


def test_merge_changes_neither_side():
    a, b = {"x": {"y": 1, "z": 2}}, {"x": {"y": 3}}
    assert merged(a, b) == {"x": {"y": 3, "z": 2}} and a == {"x": {"y": 1, "z": 2}} and b == {"x": {"y": 3}}


def test_log_lines(tmp_path):
    for _ in range(2):
        log.configure(section("logging", {"level": "INFO", "format": "json", "log_directory": tmp_path, "destination": "file"}))
    log.get_logger("t").info("batch_done", rows=3)
    lines = (tmp_path / "tidemark.log").read_text().splitlines()
    assert len(lines) == 1 and json.loads(lines[0])["rows"] == 3 and json.loads(lines[0])["event"] == "batch_done"


def test_streams_restart_without_loss_or_repeats(spark, data, tmp_path):
    top = f"file://{tmp_path}"
    rows = queries.records(spark, data, queries.JOB_JSON).where("offset < 300").persist()
    tables = silver.SilverTables.at(spark, lambda n: f"{top}/silver/{n}", CUSTOMERS.key, 4)
    for part in range(2):
        rows.where(F.col("offset") % 2 == part).write.mode("append").parquet(f"{top}/topic")
        jobs.write_bronze("customers", change_log.from_files(spark, f"{top}/topic", "events"), f"{top}/bronze", f"{top}/cp/bronze")
        jobs.write_silver(jobs.read_bronze(spark, f"{top}/bronze"), CUSTOMERS, tables, f"{top}/cp/silver")
    good = rows.where("offset % 17 <> 0 AND offset % 50 <> 0").count()
    history, rejected = tables.history.read(), tables.rejected.read()
    assert history.select("kafka_offset").distinct().count() == history.count()
    assert history.count() + rejected.count() == good
    assert tables.quarantine.read().count() == rows.where("offset % 17 <> 0 AND offset % 50 = 0").count()


@pytest.mark.parametrize("dies_before", ["history", "canonical", "rejected"])
def test_a_batch_that_broke_off_can_be_run_again(spark, data, tmp_path, monkeypatch, dies_before):
    bronze = change_log.bronze_columns(queries.records(spark, data, queries.JOB_JSON).where("offset < 200"))
    broken, whole = (silver.SilverTables.at(spark, lambda n, w=w: f"file://{tmp_path}/{w}/{n}", CUSTOMERS.key, 4) for w in ("a", "b"))
    table = getattr(broken, dies_before)
    with monkeypatch.context() as m:
        m.setattr(table, "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            silver.process_batch(bronze, CUSTOMERS, broken)
    silver.process_batch(bronze, CUSTOMERS, broken)
    silver.process_batch(bronze, CUSTOMERS, whole)
    for name in ("history", "canonical", "rejected", "quarantine"):
        a, b = (sorted(r["kafka_offset"] for r in getattr(t, name).read().collect()) for t in (broken, whole))
        assert a == b


def test_a_batch_reads_its_own_buckets_and_offsets(spark, data, tmp_path, monkeypatch):
    """History by the batch's range of offsets, the latest events by its keys' buckets; nothing else is opened, however long the history is."""
    from tidemark.store import VersionedTable

    bronze = change_log.bronze_columns(queries.records(spark, data, queries.JOB_JSON))
    tables = silver.SilverTables.at(spark, lambda n: f"file://{tmp_path}/{n}", CUSTOMERS.key, 16)
    for at in range(0, 400, 100):
        silver.process_batch(bronze.where(f"offset >= {at} AND offset < {at + 100}"), CUSTOMERS, tables)
    opened, whole = [], VersionedTable._read
    monkeypatch.setattr(VersionedTable, "_read", lambda self, schema, parts: opened.append((self.path.rpartition("/")[2], len(parts), len(self.manifest().parts))) or whole(self, schema, parts))
    one = bronze.where("offset >= 390 AND offset < 395")
    silver.process_batch(one, CUSTOMERS, tables)
    history, keyed = [x for x in opened if x[0] == "cdc_history"], [x for x in opened if x[0] in ("cdc_latest", "canonical")]
    assert history and all(parts <= 2 for _, parts, _ in history) and keyed and all(parts < total for _, parts, total in keyed)


@pytest.mark.parametrize("spec", ENTITIES.values(), ids=ENTITIES)
def test_the_jobs_of_an_environment(spark, data, tmp_path, monkeypatch, spec):
    """Bronze from files, silver, and a reconciliation, each by its environment's settings and places."""
    write(tmp_path)
    monkeypatch.chdir(tmp_path)
    layout, topic = Layout.of(get_settings()), get_settings().customer[spec.topic_setting]
    queries.records(spark, data, queries.entity_json(spec)).withColumn("topic", F.lit(topic)).write.parquet(f"file://{tmp_path}/topic")
    jobs.run_bronze(spec.name, files=f"file://{tmp_path}/topic")
    jobs.run_silver(spec.name)
    jobs.run_silver(spec.name)
    key, events = queries.KEYS[spec.name], spark.read.parquet(f"{data}/events.parquet")
    live = f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY event_id DESC) AS place FROM {{events}}) WHERE place = 1 AND event_type <> 'error'"
    rows = spark.sql(live, events=events).count()
    of = {"domain": jobs.DOMAIN, "entity": spec.name}
    assert spark.read.parquet(layout.at("bronze_job", **of)).count() == events.count()
    tables = silver.SilverTables.at(spark, lambda name: layout.at("silver_job", dataset=name, **of), spec.key)
    assert tables.history.read().count() == events.count() and tables.canonical.read().count() == rows
    queries.write_snapshot(spark, data, spec, live, layout.at("snapshot_file", domain=spec.snapshot_folder, cutoff=queries.CUTOFF))
    done = reconciliation.run(spec, queries.CUTOFF)
    assert (done["snapshot_row_count"], done["cdc_row_count"], done["exception_count"], done["overall_status"]) == (rows, rows, 0, "SUCCESS")
    again = reconciliation.run(spec, queries.CUTOFF)
    assert again["matched_row_count"] == rows and again["reconciliation_run_id"] != done["reconciliation_run_id"]
