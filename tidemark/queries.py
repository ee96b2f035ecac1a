"""Every operator as a query over the given tables, with the SQL that must give the same rows.

The change log is derived from ``events``, the snapshot and the state to be compared from ``orders``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import workspace
from tidemark.entities import ADDRESSES, CONSENTS, CUSTOMERS, EntitySpec
from tidemark.functions.text import bool_of_text
from tidemark.operators import ordering, reconcile, rules, state
from tidemark.plans import expected_state, silver
from tidemark.plans.reconciliation import ReconciliationTables, reconcile_snapshot
from tidemark.sources import change_log, envelope, snapshots
from tidemark.store import VersionedTable
from tidemark.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
T1, T2 = "2024-01-10 00:00:00", "2024-01-20 00:00:00"
EVENT = ("entity_id", "source_lsn", "kafka_partition", "kafka_offset", "cdc_operation", "value")
KEY = "entity_id"


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return add


# the change log

LOG = """user_id AS entity_id, {lsn} AS source_lsn, 'events' AS kafka_topic, CAST(event_id % 3 AS INT) AS kafka_partition, event_id AS kafka_offset,
    CASE event_type WHEN 'signup' THEN 'c' WHEN 'click' THEN 'r' WHEN 'error' THEN 'd' ELSE 'u' END AS cdc_operation, ts AS source_timestamp, value"""
DISORDERED, IN_ORDER = "(event_id * 7919) % 1009", "event_id"
WITH = f"""WITH e AS (SELECT {LOG.format(lsn=DISORDERED)} FROM events), o AS (SELECT {LOG.format(lsn=IN_ORDER)} FROM events),
early AS (SELECT * FROM e WHERE source_timestamp < TIMESTAMP '2024-01-16 00:00:00' AND entity_id % 10 <> 0),
hist AS (SELECT * FROM early a WHERE NOT EXISTS (SELECT 1 FROM early b WHERE a.entity_id = b.entity_id AND a.source_lsn = b.source_lsn AND a.kafka_partition <> b.kafka_partition)),
incoming AS (SELECT * FROM e WHERE source_timestamp >= TIMESTAMP '2024-01-14 00:00:00'),
tied AS (SELECT entity_id, source_lsn FROM incoming GROUP BY ALL HAVING count(DISTINCT kafka_partition) >= 2),
orderable AS (SELECT * FROM incoming ANTI JOIN tied USING (entity_id, source_lsn)),
seen AS (SELECT o.* FROM orderable o SEMI JOIN hist h USING (kafka_topic, kafka_partition, kafka_offset)),
fresh AS (SELECT o.* FROM orderable o ANTI JOIN hist h USING (kafka_topic, kafka_partition, kafka_offset)),
last AS (SELECT * FROM hist QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY source_lsn DESC, kafka_offset DESC) = 1),
judged AS (SELECT f.*, l.source_lsn AS persisted_source_lsn, l.kafka_partition AS persisted_kafka_partition, l.kafka_offset AS persisted_kafka_offset,
    CASE WHEN l.entity_id IS NULL THEN 'NEW' WHEN f.source_lsn > l.source_lsn THEN 'NEWER' WHEN f.source_lsn < l.source_lsn THEN 'STALE'
         WHEN f.kafka_partition <> l.kafka_partition THEN 'AMBIGUOUS_ORDERING' WHEN f.kafka_offset > l.kafka_offset THEN 'NEWER' ELSE 'STALE' END AS cdc_status
    FROM fresh f LEFT JOIN last l ON f.entity_id = l.entity_id)
"""
COLS = ", ".join(EVENT)
ENDS = "persisted_source_lsn, persisted_kafka_partition, persisted_kafka_offset"


def cdc_events(spark: SparkSession, d: str, lsn: str = DISORDERED) -> DataFrame:
    return spark.read.parquet(f"{d}/events.parquet").selectExpr(*_split_commas(LOG.format(lsn=lsn)))


def _split_commas(text: str) -> list[str]:
    out, depth, part = [], 0, ""
    for c in text:
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            out.append(part)
            part = ""
        else:
            part += c
    return [*out, part]


def hist(spark: SparkSession, d: str) -> DataFrame:
    e = cdc_events(spark, d)
    early = e.where((F.col("source_timestamp") < state.cutoff(e, "2024-01-16 00:00:00")) & (F.col(KEY) % 10 != 0))
    return early.join(ordering.ambiguous_keys(early, KEY), [KEY, "source_lsn"], "left_anti").select(*e.columns)


def incoming(spark: SparkSession, d: str) -> DataFrame:
    e = cdc_events(spark, d)
    return e.where(F.col("source_timestamp") >= state.cutoff(e, "2024-01-14 00:00:00"))


def split(spark: SparkSession, d: str) -> ordering.Split:
    return ordering.split_same_run(incoming(spark, d), KEY)


# raw layer and envelope


def records(spark: SparkSession, d: str, value: str) -> DataFrame:
    """Raw records with the value given as SQL over ``events``."""
    return spark.read.parquet(f"{d}/events.parquet").selectExpr(
        "CAST(CAST(event_id AS STRING) AS BINARY) AS key", f"CAST({value} AS BINARY) AS value", "'events' AS topic", "CAST(event_id % 3 AS INT) AS partition", "event_id AS offset", "TIMESTAMP'2024-02-01 00:00:00' AS timestamp",
        "CAST(NULL AS ARRAY<STRUCT<key: STRING, value: BINARY>>) AS headers",
    )


@query("bronze_ingest", "SELECT CAST(event_id AS VARCHAR) AS raw_key, CASE WHEN event_id % 17 <> 0 THEN props END AS raw_value, 'events' AS kafka_topic, CAST(event_id % 3 AS INT) AS kafka_partition, event_id AS kafka_offset, (event_id % 17 = 0 OR props IS NULL) AS is_tombstone FROM events")
def bronze_ingest(spark: SparkSession, d: str) -> DataFrame:
    rows = change_log.bronze_columns(records(spark, d, "CASE WHEN event_id % 17 <> 0 THEN props END"))
    return rows.select("raw_key", "raw_value", "kafka_topic", "kafka_partition", "kafka_offset", "is_tombstone")


ROW = "named_struct('customer_id', user_id, 'first_name', concat('n', event_id % 7), 'last_name', 'l', 'email', 'e@x.org', 'date_of_birth', event_id % 20000, 'status', upper(event_type), 'segment', 'GOLD', 'updated_at', concat('2024-01-', lpad(CAST(1 + event_id % 28 AS STRING), 2, '0'), 'T10:00:00Z'))"
OP = "CASE event_type WHEN 'signup' THEN 'c' WHEN 'click' THEN 'r' WHEN 'error' THEN 'd' ELSE 'u' END"
JSON = f"""CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 50 = 0 THEN 'no json' ELSE to_json(named_struct('payload', named_struct(
    'before', if(event_type = 'error', {ROW}, NULL), 'after', if(event_type <> 'error', {ROW}, NULL), 'source', named_struct('lsn', event_id * 3, 'ts_ms', 1700000000000 + event_id * 1000), 'op', {OP}, 'ts_ms', 1700000000500 + event_id * 1000))) END"""
GOOD = "(event_id % 17 <> 0 AND event_id % 50 <> 0)"


def parsed(spark: SparkSession, d: str) -> DataFrame:
    return envelope.parse(change_log.bronze_columns(records(spark, d, JSON)), CUSTOMERS.record_schema)


@query("envelope_parse", f"SELECT event_id AS kafka_offset, CASE WHEN {GOOD} THEN {OP} END AS op, CASE WHEN {GOOD} THEN event_id * 3 END AS lsn, CASE WHEN {GOOD} AND event_type <> 'error' THEN user_id END AS after_id, CASE WHEN {GOOD} AND event_type = 'error' THEN user_id END AS before_id FROM events")
def envelope_parse(spark: SparkSession, d: str) -> DataFrame:
    p = F.col("debezium.payload")
    return parsed(spark, d).select("kafka_offset", p["op"].alias("op"), p["source"]["lsn"].alias("lsn"), p["after"]["customer_id"].alias("after_id"), p["before"]["customer_id"].alias("before_id"))


@query("select_effective_record", f"SELECT event_id AS kafka_offset, CASE WHEN {GOOD} THEN user_id END AS customer_id, CASE WHEN {GOOD} THEN concat('n', event_id % 7) END AS first_name FROM events")
def select_effective_record(spark: SparkSession, d: str) -> DataFrame:
    return envelope.effective_record(parsed(spark, d), "r").select("kafka_offset", "r.customer_id", "r.first_name")


@query(
    "normalize_events",
    f"""SELECT event_id AS kafka_offset, CASE WHEN {GOOD} THEN user_id END AS customer_id, CASE WHEN {GOOD} THEN upper(event_type) END AS status,
    CASE WHEN {GOOD} THEN CAST(DATE '1970-01-01' + CAST(event_id % 20000 AS INTEGER) AS VARCHAR) END AS date_of_birth, CASE WHEN {GOOD} THEN {OP} END AS cdc_operation,
    CASE WHEN {GOOD} THEN event_id * 3 END AS source_lsn, CASE WHEN {GOOD} THEN 1700000000000 + event_id * 1000 END AS source_ms, CASE WHEN {GOOD} THEN CAST(1 + event_id % 28 AS BIGINT) END AS updated_day FROM events WHERE event_id % 17 <> 0""",
)
def normalize_events(spark: SparkSession, d: str) -> DataFrame:
    rows = silver.events(change_log.bronze_columns(records(spark, d, JSON)), CUSTOMERS)
    return rows.select("kafka_offset", "customer_id", "status", F.col("date_of_birth").cast("string").alias("date_of_birth"), "cdc_operation", "source_lsn", F.unix_millis("source_timestamp").alias("source_ms"), F.dayofmonth("updated_at").cast("long").alias("updated_day"))


@query("tombstone_filter", "SELECT event_id AS kafka_offset FROM events WHERE event_id % 17 <> 0")
def tombstone_filter(spark: SparkSession, d: str) -> DataFrame:
    return envelope.without_tombstones(change_log.bronze_columns(records(spark, d, JSON))).select("kafka_offset")


# data quality

DQ_META = """CASE WHEN event_id % 83 = 0 THEN 'x' WHEN event_id % 79 = 0 THEN NULL WHEN event_type = 'error' THEN 'd' ELSE 'u' END AS cdc_operation,
    CASE WHEN event_id % 89 <> 0 THEN event_id END AS source_lsn, CASE WHEN event_id % 61 <> 0 THEN 'events' END AS kafka_topic, CASE WHEN event_id % 67 <> 0 THEN CAST(event_id % 3 AS INT) END AS kafka_partition, CASE WHEN event_id % 59 <> 0 THEN event_id END AS kafka_offset"""
DQ_ROWS = {
    CUSTOMERS.name: f"""event_id, CASE WHEN event_id % 97 <> 0 THEN user_id END AS customer_id, CASE event_id % 11 WHEN 0 THEN NULL WHEN 1 THEN '   ' ELSE 'a' END AS first_name, CASE WHEN event_id % 73 = 0 THEN '' ELSE 'b' END AS last_name,
    CASE WHEN event_id % 13 < 3 THEN NULL ELSE 'e' END AS email, CASE WHEN event_id % 13 < 2 THEN ' ' ELSE 'p' END AS phone_number, CASE WHEN event_id % 71 = 0 THEN DATE '2999-01-01' END AS date_of_birth,
    CASE event_id % 5 WHEN 0 THEN 'ACTIVE' WHEN 1 THEN 'INACTIVE' WHEN 2 THEN 'SUSPENDED' WHEN 3 THEN 'active' END AS status, CASE event_id % 4 WHEN 0 THEN 'STANDARD' WHEN 1 THEN 'GOLD' WHEN 2 THEN 'PREMIUM' ELSE 'VIP' END AS segment, {DQ_META}""",
    ADDRESSES.name: f"""event_id, CASE WHEN event_id % 97 <> 0 THEN event_id END AS address_id, CASE WHEN event_id % 53 <> 0 THEN user_id END AS customer_id, CASE event_id % 6 WHEN 0 THEN 'HOME' WHEN 1 THEN 'SHIPPING' WHEN 2 THEN 'BILLING' WHEN 3 THEN ' home ' WHEN 4 THEN 'HOME' END AS address_type,
    CASE WHEN event_id % 11 = 0 THEN ' ' ELSE 'l' END AS address_line_1, CASE WHEN event_id % 13 <> 0 THEN 'c' END AS city, CASE WHEN event_id % 17 = 0 THEN '' ELSE '1' END AS postal_code, CASE WHEN event_id % 19 <> 0 THEN 'X' END AS country, CASE WHEN event_id % 23 <> 0 THEN event_id % 2 = 0 END AS is_primary, {DQ_META}""",
    CONSENTS.name: f"""event_id, CASE WHEN event_id % 97 <> 0 THEN event_id END AS consent_id, CASE WHEN event_id % 53 <> 0 THEN user_id END AS customer_id, CASE event_id % 5 WHEN 0 THEN 'EMAIL' WHEN 1 THEN 'SMS' WHEN 2 THEN ' ' WHEN 3 THEN 'OTHER' END AS consent_type, CASE WHEN event_id % 7 <> 0 THEN event_id % 2 = 0 END AS granted, {DQ_META}""",
}


def _case(code: str, wrong: str) -> str:
    return f"CASE WHEN {wrong} THEN '{code}' END"


def _empty(c: str) -> str:
    return f"{c} IS NULL OR trim({c}, ' ') = ''"


def _tags(key: str, business: list[tuple[str, str]]) -> str:
    always = [("INVALID_CDC_OPERATION", "cdc_operation IS NULL OR cdc_operation NOT IN ('c', 'u', 'r', 'd')"), *((f"MISSING_{c.upper()}", f"{c} IS NULL") for c in (key, "kafka_topic", "kafka_partition", "kafka_offset", "source_lsn"))]
    join = lambda rs: f"concat_ws(',', {', '.join(_case(*r) for r in rs)})"
    return f"CASE WHEN cdc_operation = 'd' THEN {join(always)} ELSE {join([*always, *business])} END"


DQ_TAGS = {
    CUSTOMERS.name: _tags(
        "customer_id",
        [("MISSING_FIRST_NAME", _empty("first_name")), ("MISSING_LAST_NAME", _empty("last_name")), ("MISSING_CONTACT_INFO", f"({_empty('email')}) AND ({_empty('phone_number')})"), ("FUTURE_DATE_OF_BIRTH", "date_of_birth > current_date"), ("INVALID_STATUS", "status IS NULL OR status NOT IN ('ACTIVE', 'INACTIVE', 'SUSPENDED')"), ("INVALID_SEGMENT", "segment IS NULL OR segment NOT IN ('STANDARD', 'GOLD', 'PREMIUM')")],
    ),
    ADDRESSES.name: _tags(
        "address_id",
        [("MISSING_CUSTOMER_ID", "customer_id IS NULL"), ("INVALID_ADDRESS_TYPE", "address_type IS NULL OR address_type NOT IN ('HOME', 'SHIPPING', 'BILLING')"), *((f"MISSING_{c.upper()}", _empty(c)) for c in ("address_line_1", "city", "postal_code", "country")), ("MISSING_IS_PRIMARY", "is_primary IS NULL")],
    ),
    CONSENTS.name: _tags("consent_id", [("MISSING_CUSTOMER_ID", "customer_id IS NULL"), ("MISSING_CONSENT_TYPE", _empty("consent_type")), ("MISSING_GRANTED", "granted IS NULL")]),
}


def dq_rows(spark: SparkSession, d: str, spec: EntitySpec) -> DataFrame:
    return silver.tagged(spark.read.parquet(f"{d}/events.parquet").selectExpr(*_split_commas(DQ_ROWS[spec.name])), spec)


def _dq(spec: EntitySpec) -> Query:
    return lambda spark, d: dq_rows(spark, d, spec).select("event_id", F.array_join("dq_errors", ",").alias("errors"))


for _name, _spec in (("dq_tag_customers", CUSTOMERS), ("dq_tag_addresses", ADDRESSES), ("dq_tag_consents", CONSENTS)):
    query(_name, f"SELECT event_id, {DQ_TAGS[_spec.name]} AS errors FROM (SELECT {DQ_ROWS[_spec.name]} FROM events)")(_dq(_spec))
DQ_TAGGED = f"SELECT *, {DQ_TAGS[CUSTOMERS.name]} AS errors FROM (SELECT {DQ_ROWS[CUSTOMERS.name]} FROM events)"


@query("dq_valid", f"SELECT event_id, customer_id, status, segment FROM ({DQ_TAGGED}) WHERE errors = ''")
def dq_valid(spark: SparkSession, d: str) -> DataFrame:
    return rules.valid(dq_rows(spark, d, CUSTOMERS)).select("event_id", "customer_id", "status", "segment")


@query("dq_quarantine", f"SELECT event_id, errors, CAST(len(string_split(errors, ',')) AS INT) AS dq_error_count FROM ({DQ_TAGGED}) WHERE errors <> ''")
def dq_quarantine(spark: SparkSession, d: str) -> DataFrame:
    return rules.quarantine(dq_rows(spark, d, CUSTOMERS)).select("event_id", F.array_join("dq_errors", ",").alias("errors"), "dq_error_count")


# ordering


@query("dedup_kafka_identity", f"{WITH} SELECT DISTINCT {COLS} FROM incoming")
def dedup_kafka_identity(spark: SparkSession, d: str) -> DataFrame:
    rows = incoming(spark, d)
    return ordering.without_replays(rows.unionAll(rows.where("kafka_offset % 7 = 0"))).select(*EVENT)


@query("ambiguous_keys", f"{WITH} SELECT entity_id, source_lsn FROM tied")
def ambiguous_keys(spark: SparkSession, d: str) -> DataFrame:
    return ordering.ambiguous_keys(incoming(spark, d), KEY)


@query("split_ambiguous", f"{WITH} SELECT {COLS}, 'AMBIGUOUS_ORDERING' AS cdc_status FROM incoming SEMI JOIN tied USING (entity_id, source_lsn)")
def split_ambiguous(spark: SparkSession, d: str) -> DataFrame:
    return split(spark, d).ambiguous.select(*EVENT, "cdc_status")


@query("split_orderable", f"{WITH} SELECT {COLS} FROM orderable")
def split_orderable(spark: SparkSession, d: str) -> DataFrame:
    return split(spark, d).orderable.select(*EVENT)


@query("replay_detect", f"{WITH} SELECT {COLS} FROM seen")
def replay_detect(spark: SparkSession, d: str) -> DataFrame:
    return ordering.replays(split(spark, d).orderable, hist(spark, d)).select(*EVENT)


@query("replay_exclude", f"{WITH} SELECT {COLS} FROM fresh")
def replay_exclude(spark: SparkSession, d: str) -> DataFrame:
    return ordering.unseen(split(spark, d).orderable, hist(spark, d)).select(*EVENT)


@query("latest_history", f"{WITH} SELECT {COLS} FROM last")
def latest_history(spark: SparkSession, d: str) -> DataFrame:
    return ordering.latest_per_key(hist(spark, d), KEY).select(*EVENT)


@query("classify_history", f"{WITH} SELECT {COLS}, {ENDS}, cdc_status FROM judged")
def classify_history(spark: SparkSession, d: str) -> DataFrame:
    before = hist(spark, d)
    return ordering.with_status(ordering.unseen(split(spark, d).orderable, before), before, KEY).select(*EVENT, *ENDS.split(", "), "cdc_status")


ACCEPTED = f"SELECT {COLS} FROM judged WHERE cdc_status IN ('NEW', 'NEWER') UNION ALL SELECT {COLS} FROM seen"


@query("classify_accepted", f"{WITH} {ACCEPTED}")
def classify_accepted(spark: SparkSession, d: str) -> DataFrame:
    return ordering.classify(split(spark, d), hist(spark, d), KEY).accepted.select(*EVENT)


@query("classify_rejected", f"{WITH} SELECT {COLS}, {ENDS}, cdc_status FROM judged WHERE cdc_status IN ('STALE', 'AMBIGUOUS_ORDERING') UNION ALL SELECT {COLS}, NULL, NULL, NULL, 'AMBIGUOUS_ORDERING' FROM incoming SEMI JOIN tied USING (entity_id, source_lsn)")
def classify_rejected(spark: SparkSession, d: str) -> DataFrame:
    return ordering.classify(split(spark, d), hist(spark, d), KEY).rejected.select(*EVENT, *ENDS.split(", "), "cdc_status")


# tables


@query("merge_events_insert_only", f"{WITH} SELECT {COLS} FROM hist UNION ALL SELECT {COLS} FROM incoming ANTI JOIN hist USING (kafka_topic, kafka_partition, kafka_offset)")
def merge_events_insert_only(spark: SparkSession, d: str) -> DataFrame:
    table = VersionedTable(spark, workspace.folder(spark))
    silver.write_events(table, hist(spark, d))
    silver.write_events(table, incoming(spark, d))
    return table.read().select(*EVENT)


@query("canonical_apply_initial", f"{WITH} SELECT {COLS} FROM last WHERE cdc_operation <> 'd'")
def canonical_apply_initial(spark: SparkSession, d: str) -> DataFrame:
    table = VersionedTable(spark, workspace.folder(spark), (KEY,), 16)
    silver.apply_canonical(table, hist(spark, d), KEY)
    return table.read().select(*EVENT)


@query("canonical_apply_merge", f"{WITH}, known AS (SELECT {COLS} FROM hist UNION {ACCEPTED}) SELECT {COLS} FROM (SELECT * FROM known QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY source_lsn DESC, kafka_offset DESC) = 1) WHERE cdc_operation <> 'd'")
def canonical_apply_merge(spark: SparkSession, d: str) -> DataFrame:
    top = workspace.folder(spark)
    table, history = VersionedTable(spark, f"{top}/canonical", (KEY,), 16), VersionedTable(spark, f"{top}/history")
    silver.write_events(history, hist(spark, d))
    silver.apply_canonical(table, history.read(), KEY)
    accepted = ordering.classify(split(spark, d), history.read(), KEY).accepted
    silver.write_events(history, accepted)
    silver.apply_canonical(table, accepted, KEY, history.read())
    return table.read().select(*EVENT)


# state at cutoffs


def _state(source: str, as_of: str) -> str:
    return f"SELECT * FROM (SELECT * FROM {source} WHERE source_timestamp <= TIMESTAMP '{as_of}' QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY source_lsn DESC, kafka_offset DESC) = 1) WHERE cdc_operation <> 'd'"


def _interval(source: str) -> str:
    return f"SELECT * FROM {source} WHERE source_timestamp > TIMESTAMP '{T1}' AND source_timestamp <= TIMESTAMP '{T2}'"


LAST = "QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY source_lsn DESC, kafka_offset DESC) = 1"
MERGED = f"""WITH o AS (SELECT {LOG.format(lsn=IN_ORDER)} FROM events), s1 AS ({_state("o", T1)}), s2 AS ({_state("o", T2)}), d AS ({_interval("o")} {LAST}),
m AS (SELECT CAST(count(*) FILTER (d.cdc_operation <> 'd' AND s1.entity_id IS NULL) AS BIGINT) AS inserted, CAST(count(*) FILTER (d.cdc_operation <> 'd' AND s1.entity_id IS NOT NULL) AS BIGINT) AS updated,
      CAST(count(*) FILTER (d.cdc_operation = 'd' AND s1.entity_id IS NOT NULL) AS BIGINT) AS deleted FROM d LEFT JOIN s1 ON d.entity_id = s1.entity_id)"""


@query("state_as_of", f"WITH e AS (SELECT {LOG.format(lsn=DISORDERED)} FROM events) SELECT {COLS} FROM ({_state('e', T2)})")
def state_as_of(spark: SparkSession, d: str) -> DataFrame:
    return state.latest_as_of(cdc_events(spark, d), T2, KEY).select(*EVENT)


@query("high_water_mark", "SELECT strftime(max(date_trunc('day', ts)), '%Y-%m-%d %H:%M:%S') AS state_as_of FROM events")
def high_water_mark(spark: SparkSession, d: str) -> DataFrame:
    metadata = spark.read.parquet(f"{d}/events.parquet").select(F.date_trunc("day", F.col("ts").cast("timestamp")).alias("state_as_of"))
    return state.high_water_mark(metadata).select(F.date_format("state_as_of", "yyyy-MM-dd HH:mm:ss").alias("state_as_of"))


@query("incremental_interval", f"WITH e AS (SELECT {LOG.format(lsn=DISORDERED)} FROM events) SELECT {COLS} FROM ({_interval('e')})")
def incremental_interval(spark: SparkSession, d: str) -> DataFrame:
    return state.interval(cdc_events(spark, d), T1, T2).select(*EVENT)


@query("incremental_latest", f"WITH e AS (SELECT {LOG.format(lsn=DISORDERED)} FROM events) SELECT {COLS} FROM ({_interval('e')} {LAST})")
def incremental_latest(spark: SparkSession, d: str) -> DataFrame:
    return state.latest_of_interval(state.interval(cdc_events(spark, d), T1, T2), KEY, T2).select(*EVENT)


def _advanced(spark: SparkSession, d: str) -> tuple[expected_state.Advance, VersionedTable]:
    top, log = workspace.folder(spark), cdc_events(spark, d, IN_ORDER)
    table, metadata = VersionedTable(spark, f"{top}/state", (KEY,), 16), VersionedTable(spark, f"{top}/metadata")
    expected_state.advance(log, table, metadata, KEY, "users", T1, "first")
    return expected_state.advance(log, table, metadata, KEY, "users", T2, "second"), metadata


@query("expected_state_advance", f"{MERGED} SELECT {COLS} FROM s2")
def expected_state_advance(spark: SparkSession, d: str) -> DataFrame:
    return _advanced(spark, d)[0].state.select(*EVENT)


@query("merge_metrics", f"{MERGED} SELECT inserted AS num_inserted_rows, updated AS num_updated_rows, deleted AS num_deleted_rows FROM m")
def merge_metrics(spark: SparkSession, d: str) -> DataFrame:
    c = _advanced(spark, d)[0].counts
    return spark.range(1).select(F.lit(c.num_inserted_rows).cast("long").alias("num_inserted_rows"), F.lit(c.num_updated_rows).cast("long").alias("num_updated_rows"), F.lit(c.num_deleted_rows).cast("long").alias("num_deleted_rows"))


@query(
    "expected_state_metadata",
    f"""{MERGED} SELECT 'first' AS reconciliation_run_id, count(*) AS state_row_count, count(*) AS records_inserted, CAST(0 AS BIGINT) AS records_updated, CAST(0 AS BIGINT) AS records_deleted, count(*) AS processed_cdc_rows FROM s1
    UNION ALL SELECT 'second', (SELECT count(*) FROM s2), inserted, updated, deleted, (SELECT count(*) FROM ({_interval("o")})) FROM m""",
)
def expected_state_metadata(spark: SparkSession, d: str) -> DataFrame:
    return _advanced(spark, d)[1].read().select("reconciliation_run_id", "state_row_count", "records_inserted", "records_updated", "records_deleted", "processed_cdc_rows")


# snapshots

SNAP_ROWS = """c_custkey AS customer_id, CASE WHEN c_custkey % 11 = 0 THEN '  ' ELSE c_name END AS first_name, 'l' AS last_name, CASE WHEN c_custkey % 7 <> 0 THEN 'e' END AS email, CASE WHEN c_custkey % 14 <> 0 THEN 'p' END AS phone_number,
    CASE WHEN c_custkey % 13 = 0 THEN 'x' WHEN c_custkey % 17 = 0 THEN '2999-01-01' ELSE '1990-01-02' END AS date_of_birth, CASE WHEN c_custkey % 5 = 0 THEN 'GONE' ELSE 'ACTIVE' END AS status, 'GOLD' AS segment, '2024-01-01 00:00:00' AS created_at, '2024-01-02 00:00:00' AS updated_at"""
SNAP_DATE = "TRY_CAST(date_of_birth AS DATE)"
CSV = f"SELECT {SNAP_ROWS} FROM customer"


def csv_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """A snapshot file written from ``customer`` and loaded as a job would."""
    path = workspace.folder(spark)
    spark.read.parquet(f"{d}/customer.parquet").selectExpr(*_split_commas(SNAP_ROWS)).write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return snapshots.load(spark, path, CUSTOMERS)


@query("snapshot_load", f"SELECT customer_id, first_name, email, CAST({SNAP_DATE} AS VARCHAR) AS date_of_birth, status FROM ({CSV})")
def snapshot_load(spark: SparkSession, d: str) -> DataFrame:
    return csv_snapshot(spark, d).select("customer_id", "first_name", "email", F.col("date_of_birth").cast("string").alias("date_of_birth"), "status")


@query("snapshot_metadata", "SELECT c_custkey AS customer_id, 'customers_snapshot_20240120' AS batch_id, 'customers_snapshot_2024-01-20.csv' AS source_filename, '2024-01-20' AS source_date, 1 AS schema_version FROM customer")
def snapshot_metadata(spark: SparkSession, d: str) -> DataFrame:
    rows = spark.read.parquet(f"{d}/customer.parquet").selectExpr("c_custkey AS customer_id")
    return snapshots.with_metadata(rows, "customers", T2).select("customer_id", "batch_id", "source_filename", F.col("source_date").cast("string").alias("source_date"), "schema_version")


SNAP_ERRORS = ", ".join(
    _case(*r) for r in [("MISSING_FIRST_NAME", _empty("first_name")), ("MISSING_CONTACT_INFO", f"({_empty('email')}) AND ({_empty('phone_number')})"), ("FUTURE_DATE_OF_BIRTH", f"{SNAP_DATE} > DATE '2024-01-20'"), ("INVALID_STATUS", "status NOT IN ('ACTIVE', 'INACTIVE', 'SUSPENDED')")]
)


@query("snapshot_validate", f"SELECT customer_id, concat_ws(',', {SNAP_ERRORS}) AS errors FROM ({CSV})")
def snapshot_validate(spark: SparkSession, d: str) -> DataFrame:
    return snapshots.tagged(csv_snapshot(spark, d), CUSTOMERS, T2).select("customer_id", F.array_join("snapshot_errors", ",").alias("errors"))


@query("snapshot_duplicate_keys", "SELECT l_orderkey, count(*) AS count FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def snapshot_duplicate_keys(spark: SparkSession, d: str) -> DataFrame:
    return rules.repeated_keys(spark.read.parquet(f"{d}/lineitem.parquet").select("l_orderkey"), "l_orderkey")


@query("bool_text_normalize", "SELECT event_id, CASE WHEN event_id % 8 IN (0, 2, 4) THEN true WHEN event_id % 8 IN (1, 3) THEN false END AS flag FROM events")
def bool_text_normalize(spark: SparkSession, d: str) -> DataFrame:
    text = F.expr("CASE event_id % 8 WHEN 0 THEN 't' WHEN 1 THEN 'F' WHEN 2 THEN ' true ' WHEN 3 THEN '0' WHEN 4 THEN '1' WHEN 5 THEN 'x' WHEN 6 THEN '' END")
    return spark.read.parquet(f"{d}/events.parquet").select("event_id", bool_of_text(text).alias("flag"))


# reconciliation

STATE_ROWS = "o_orderkey AS k, o_orderstatus AS status, o_orderpriority AS prio, CAST(round(o_totalprice * 100) AS BIGINT) AS cents"
SNAP_SIDE = "o_orderkey AS k, CASE WHEN o_orderkey % 5 = 0 THEN concat('  ', lower(o_orderstatus), ' ') ELSE o_orderstatus END AS status, CASE WHEN o_orderkey % 101 <> 0 THEN o_orderpriority END AS prio, CAST(round(o_totalprice * 100) AS BIGINT) + CASE WHEN o_orderkey % 89 = 0 THEN 1 ELSE 0 END AS cents"
CHECKSUM = ("CAST(k AS STRING)", "upper(trim(status))", "trim(prio)", "CAST(cents AS STRING)")
COMPARE = ("status", "prio", "cents")
SUM = "sha256(concat_ws('||', CAST(k AS VARCHAR), upper(trim(status, ' ')), coalesce(trim(prio, ' '), '__NULL__'), CAST(cents AS VARCHAR)))"
SIDES = f"""WITH st AS (SELECT *, {SUM} AS h FROM (SELECT {STATE_ROWS} FROM orders WHERE o_orderkey % 83 <> 0)), sn AS (SELECT *, {SUM} AS h FROM (SELECT {SNAP_SIDE} FROM orders WHERE o_orderkey % 97 <> 0)),
r AS (SELECT coalesce(sn.k, st.k) AS k, sn.h AS snapshot_row_checksum, st.h AS cdc_row_checksum,
    CASE WHEN sn.k IS NULL THEN 'MISSING_IN_SNAPSHOT' WHEN st.k IS NULL THEN 'MISSING_IN_CDC' WHEN sn.h <> st.h THEN 'CHECKSUM_MISMATCH' ELSE 'MATCH' END AS reconciliation_status,
    concat_ws(',', CASE WHEN sn.status IS DISTINCT FROM st.status THEN 'STATUS_MISMATCH' END, CASE WHEN sn.prio IS DISTINCT FROM st.prio THEN 'PRIO_MISMATCH' END, CASE WHEN sn.cents IS DISTINCT FROM st.cents THEN 'CENTS_MISMATCH' END) AS fields
    FROM sn FULL OUTER JOIN st ON sn.k = st.k)"""
BUCKETS = 64


def order_state(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/orders.parquet").where("o_orderkey % 83 <> 0").selectExpr(*_split_commas(STATE_ROWS))


def order_snapshot(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/orders.parquet").where("o_orderkey % 97 <> 0").selectExpr(*_split_commas(SNAP_SIDE))


@query("snapshot_dedup_strict", f"SELECT k, status, prio, cents FROM (SELECT {SNAP_SIDE} FROM orders WHERE o_orderkey % 97 <> 0) WHERE k % 211 <> 0")
def snapshot_dedup_strict(spark: SparkSession, d: str) -> DataFrame:
    rows = order_snapshot(spark, d)
    return rules.drop_repeated_keys(rows.unionAll(rows.where("k % 211 = 0")), "k")


@query("row_checksum", f"{SIDES} SELECT 'snapshot' AS side, k, h AS checksum FROM sn UNION ALL SELECT 'cdc', k, h FROM st")
def row_checksum(spark: SparkSession, d: str) -> DataFrame:
    one = lambda df, side: df.select(F.lit(side).alias("side"), "k", reconcile.row_checksum(CHECKSUM).alias("checksum"))
    return one(order_snapshot(spark, d), "snapshot").unionAll(one(order_state(spark, d), "cdc"))


def _digest(side: str, table: str) -> str:
    return f"SELECT CAST(k % {BUCKETS} AS INT) + 1 AS bucket_id, count(k) AS {side}_row_count, sha256(string_agg(h, '||' ORDER BY h)) AS {side}_checksum FROM {table} GROUP BY 1"


@query(
    "recon_buckets",
    f"""{SIDES}, a AS ({_digest("snapshot", "sn")}), b AS ({_digest("cdc", "st")})
    SELECT coalesce(a.bucket_id, b.bucket_id) AS bucket_id, snapshot_row_count, snapshot_checksum, cdc_row_count, cdc_checksum, CASE WHEN a.bucket_id IS NULL THEN 'MISSING_IN_SNAPSHOT' WHEN b.bucket_id IS NULL THEN 'MISSING_IN_CDC'
    WHEN snapshot_row_count <> cdc_row_count THEN 'COUNT_MISMATCH' WHEN snapshot_checksum <> cdc_checksum THEN 'CHECKSUM_MISMATCH' ELSE 'MATCH' END AS reconciliation_status FROM a FULL OUTER JOIN b ON a.bucket_id = b.bucket_id""",
)
def recon_buckets(spark: SparkSession, d: str) -> DataFrame:
    side = lambda df, name: reconcile.checksums(df, "k", CHECKSUM, BUCKETS, name, by_value=True)
    return reconcile.compare_buckets(side(order_snapshot(spark, d), "snapshot"), side(order_state(spark, d), "cdc"), "k", as_text=True)


def _rows(spark: SparkSession, d: str) -> DataFrame:
    side = lambda df, name: reconcile.checksums(df, "k", CHECKSUM, BUCKETS, name)
    return reconcile.compare_rows(side(order_snapshot(spark, d), "snapshot"), side(order_state(spark, d), "cdc"), "k", COMPARE)


@query("recon_row_status", f"{SIDES} SELECT k, reconciliation_status FROM r")
def recon_row_status(spark: SparkSession, d: str) -> DataFrame:
    return _rows(spark, d).select("k", "reconciliation_status")


@query("field_mismatch", f"{SIDES} SELECT k, fields FROM r WHERE snapshot_row_checksum IS NOT NULL AND cdc_row_checksum IS NOT NULL")
def field_mismatch(spark: SparkSession, d: str) -> DataFrame:
    both = _rows(spark, d).where("snapshot_present AND cdc_present")
    return both.select("k", F.array_join(reconcile.differing_fields(COMPARE), ",").alias("fields"))


def _exceptions(spark: SparkSession, d: str) -> DataFrame:
    return reconcile.exceptions(order_snapshot(spark, d), order_state(spark, d), "k", CHECKSUM, COMPARE, 4096)


@query("recon_exceptions", f"{SIDES} SELECT k, snapshot_row_checksum, cdc_row_checksum, reconciliation_status, CASE WHEN reconciliation_status = 'CHECKSUM_MISMATCH' THEN fields ELSE '' END AS mismatch_columns FROM r WHERE reconciliation_status <> 'MATCH'")
def recon_exceptions(spark: SparkSession, d: str) -> DataFrame:
    return _exceptions(spark, d).select("k", "snapshot_row_checksum", "cdc_row_checksum", "reconciliation_status", F.array_join("mismatch_columns", ",").alias("mismatch_columns"))


SUMMARY = ("snapshot_row_count", "cdc_row_count", "exception_count", "missing_in_cdc_count", "missing_in_snapshot_count", "checksum_mismatch_count", "matched_row_count", "overall_status")


@query(
    "recon_run_summary",
    f"""{SIDES} SELECT (SELECT count(*) FROM sn) AS snapshot_row_count, (SELECT count(*) FROM st) AS cdc_row_count, count(*) FILTER (reconciliation_status <> 'MATCH') AS exception_count, count(*) FILTER (reconciliation_status = 'MISSING_IN_CDC') AS missing_in_cdc_count,
    count(*) FILTER (reconciliation_status = 'MISSING_IN_SNAPSHOT') AS missing_in_snapshot_count, count(*) FILTER (reconciliation_status = 'CHECKSUM_MISMATCH') AS checksum_mismatch_count, count(*) FILTER (reconciliation_status = 'MATCH') AS matched_row_count,
    CASE WHEN count(*) FILTER (reconciliation_status <> 'MATCH') = 0 THEN 'SUCCESS' ELSE 'COMPLETED_WITH_EXCEPTIONS' END AS overall_status FROM r""",
)
def recon_run_summary(spark: SparkSession, d: str) -> DataFrame:
    return reconcile.run_summary(order_snapshot(spark, d), order_state(spark, d), _exceptions(spark, d), "run", T2, "orders").select(*SUMMARY)


# whole jobs


@query("silver_microbatch")
def silver_microbatch(spark: SparkSession, d: str) -> DataFrame:
    """One batch over all records; the live rows of the canonical table."""
    top = workspace.folder(spark)
    tables = silver.SilverTables.at(spark, lambda name: f"{top}/{name}", CUSTOMERS.key, 16)
    silver.process_batch(change_log.bronze_columns(records(spark, d, JOB_JSON)), CUSTOMERS, tables)
    return tables.canonical.read().select("customer_id", "kafka_offset")


@query("stream_bronze_to_silver")
def stream_bronze_to_silver(spark: SparkSession, d: str) -> DataFrame:
    """Records as files, then both streaming jobs; the live rows of the canonical table."""
    top = workspace.folder(spark)
    records(spark, d, JOB_JSON).write.parquet(f"{top}/topic")
    jobs.write_bronze(CUSTOMERS.name, change_log.from_files(spark, f"{top}/topic", "events"), f"{top}/bronze", f"{top}/checkpoints/bronze")
    tables = silver.SilverTables.at(spark, lambda name: f"{top}/silver/{name}", CUSTOMERS.key, 16)
    jobs.write_silver(jobs.read_bronze(spark, f"{top}/bronze"), CUSTOMERS, tables, f"{top}/checkpoints/silver")
    return tables.canonical.read().select("customer_id", "kafka_offset")


@query(
    "silver_two_batches",
    f"""WITH e AS (SELECT {LOG.format(lsn=DISORDERED)}, event_id, event_id % 50 = 0 AS broken FROM events WHERE event_id % 17 <> 0),
    early AS (SELECT * FROM e WHERE source_timestamp < TIMESTAMP '2024-01-16 00:00:00'), late AS (SELECT * FROM e WHERE source_timestamp >= TIMESTAMP '2024-01-14 00:00:00'),
    tied1 AS (SELECT entity_id, source_lsn FROM early WHERE NOT broken GROUP BY ALL HAVING count(DISTINCT kafka_partition) > 1), hist AS (SELECT * FROM early ANTI JOIN tied1 USING (entity_id, source_lsn) WHERE NOT broken),
    tied2 AS (SELECT entity_id, source_lsn FROM late WHERE NOT broken GROUP BY ALL HAVING count(DISTINCT kafka_partition) > 1), orderable AS (SELECT * FROM late ANTI JOIN tied2 USING (entity_id, source_lsn) WHERE NOT broken),
    last AS (SELECT * FROM hist {{LAST}}), fresh AS (SELECT * FROM orderable ANTI JOIN hist USING (kafka_offset)),
    judged AS (SELECT f.*, CASE WHEN l.entity_id IS NULL THEN 'NEW' WHEN f.source_lsn > l.source_lsn THEN 'NEWER' WHEN f.source_lsn < l.source_lsn THEN 'STALE' WHEN f.kafka_partition <> l.kafka_partition THEN 'AMBIGUOUS_ORDERING' WHEN f.kafka_offset > l.kafka_offset THEN 'NEWER' ELSE 'STALE' END AS cdc_status
        FROM fresh f LEFT JOIN last l ON f.entity_id = l.entity_id),
    after AS (SELECT entity_id, source_lsn, kafka_offset, cdc_operation FROM hist UNION ALL SELECT entity_id, source_lsn, kafka_offset, cdc_operation FROM judged WHERE cdc_status IN ('NEW', 'NEWER')),
    lost AS (SELECT kafka_offset, 'AMBIGUOUS_ORDERING' AS status FROM early SEMI JOIN tied1 USING (entity_id, source_lsn) WHERE NOT broken),
    lost2 AS (SELECT kafka_offset, cdc_status AS status FROM judged WHERE cdc_status NOT IN ('NEW', 'NEWER') UNION ALL SELECT kafka_offset, 'AMBIGUOUS_ORDERING' FROM late SEMI JOIN tied2 USING (entity_id, source_lsn) WHERE NOT broken)
    SELECT 'quarantine' AS dataset, kafka_offset, 'INVALID_CDC_OPERATION,MISSING_CUSTOMER_ID,MISSING_SOURCE_LSN' AS status FROM e WHERE broken UNION ALL SELECT 'history', kafka_offset, cdc_operation FROM after
    UNION ALL SELECT 'canonical', kafka_offset, cdc_operation FROM (SELECT * FROM after {{LAST}}) WHERE cdc_operation <> 'd' UNION ALL SELECT 'latest', kafka_offset, cdc_operation FROM after {{LAST}}
    UNION ALL SELECT 'rejected', kafka_offset, status FROM lost UNION ALL SELECT 'rejected', kafka_offset, status FROM lost2 ANTI JOIN lost USING (kafka_offset)""".replace("{LAST}", LAST),
)
def silver_two_batches(spark: SparkSession, d: str) -> DataFrame:
    """Two batches that overlap by two days, so that the second finds history, replays, stale and ambiguous events; all tables read back."""
    top = workspace.folder(spark)
    tables = silver.SilverTables.at(spark, lambda name: f"{top}/{name}", CUSTOMERS.key, 16)
    times = spark.read.parquet(f"{d}/events.parquet").select(F.col("event_id").alias("offset"), "ts")
    every = records(spark, d, JOB_JSON.replace("event_id * 3", DISORDERED)).join(times, "offset")
    for batch in (every.where(F.col("ts") < state.cutoff(times, "2024-01-16 00:00:00", "ts")), every.where(F.col("ts") >= state.cutoff(times, "2024-01-14 00:00:00", "ts"))):
        silver.process_batch(change_log.bronze_columns(batch.drop("ts")), CUSTOMERS, tables)
    read = lambda name, status: getattr(tables, name).read().select(F.lit(name).alias("dataset"), "kafka_offset", status.alias("status"))
    out = read("quarantine", F.array_join(F.filter("dq_errors", lambda c: c.isin("INVALID_CDC_OPERATION", "MISSING_CUSTOMER_ID", "MISSING_SOURCE_LSN")), ","))
    for name, column in (("history", "cdc_operation"), ("canonical", "cdc_operation"), ("latest", "cdc_operation"), ("rejected", "cdc_status")):
        out = out.unionAll(read(name, F.col(column)))
    return out


# the three entities: event columns, snapshots, checksums, whole reconciliation runs. Rows are derived from ``events``; the key is the event's user, or the event for addresses and consents


def _entity_rows(spec: EntitySpec) -> dict[str, tuple[str, str]]:
    """By column, its SQL in the change log's JSON and in the snapshot's file."""
    when = "'2024-01-02T03:04:05Z'", "'2024-01-02 03:04:05'"
    if spec is CUSTOMERS:
        text = {"first_name": "concat(' n', event_id % 7, ' ')", "last_name": "'l'", "phone_number": "CASE WHEN event_id % 2 = 0 THEN 'p' END"}
        return {"customer_id": ("user_id",) * 2, **{c: (x, x) for c, x in text.items()}, "email": ("concat('E', event_id % 3, '@x.org')", "concat(' e', event_id % 3, '@X.org')"), "date_of_birth": ("CAST(event_id % 9 AS INT)", "concat('1970-01-0', 1 + event_id % 9)"), "status": ("'ACTIVE'",) * 2, "segment": ("'GOLD'",) * 2, "created_at": when, "updated_at": when}
    if spec is ADDRESSES:
        text = {"address_line_1": "concat('l', event_id)", "address_line_2": "CASE WHEN event_id % 3 = 0 THEN 'z' END", "city": "concat('c', event_id % 5)", "state": "'S'", "postal_code": "'1'", "country": "'nl'"}
        return {"address_id": ("event_id",) * 2, "customer_id": ("user_id",) * 2, "address_type": ("CASE event_id % 3 WHEN 0 THEN 'HOME' WHEN 1 THEN 'SHIPPING' ELSE 'BILLING' END",) * 2, **{c: (x, x) for c, x in text.items()}, "is_primary": ("event_id % 2 = 0", "CASE WHEN event_id % 2 = 0 THEN ' T' ELSE '0' END"), "created_at": when, "updated_at": when}
    return {"consent_id": ("event_id",) * 2, "customer_id": ("user_id",) * 2, "consent_type": ("CASE WHEN event_id % 2 = 0 THEN 'EMAIL' ELSE 'SMS' END",) * 2, "granted": ("event_id % 3 = 0", "CASE WHEN event_id % 3 = 0 THEN 'true' ELSE 'F' END"), "created_at": when, "updated_at": when}


def entity_json(spec: EntitySpec) -> str:
    row = ", ".join(f"'{c}', {x}" for c, (x, _) in _entity_rows(spec).items())
    return f"to_json(named_struct('payload', named_struct('before', if(event_type = 'error', named_struct({row}), NULL), 'after', if(event_type <> 'error', named_struct({row}), NULL), 'source', named_struct('lsn', event_id, 'ts_ms', 1700000000000 + event_id * 1000), 'op', {OP}, 'ts_ms', 1700000000000)))"


def entity_events(spark: SparkSession, d: str, spec: EntitySpec) -> DataFrame:
    return silver.events(change_log.bronze_columns(records(spark, d, entity_json(spec))), spec)


def write_snapshot(spark: SparkSession, d: str, spec: EntitySpec, rows: str, path: str, **over: str) -> None:
    """The rows of this SQL over ``events`` as a snapshot file; over: columns with other SQL."""
    events = spark.read.parquet(f"{d}/events.parquet")
    found = rows.format(events="{events}")
    columns = [f"{over.get(c, _entity_rows(spec)[c][1])} AS {c}" for c in spec.snapshot_schema.names]
    text = spark.sql(found, events=events).selectExpr(*columns)
    text.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def entity_snapshot(spark: SparkSession, d: str, spec: EntitySpec, rows: str, **over: str) -> DataFrame:
    """Such a file, loaded as a job would."""
    path = workspace.folder(spark)
    write_snapshot(spark, d, spec, rows, path, **over)
    return snapshots.load(spark, path, spec)


def _null(x: str) -> str:
    return f"coalesce({x}, '__NULL__')"


MOMENT = "'2024-01-02 03:04:05.000000'"
# normalised values of these rows, as the specification of each entity's checksum gives them
CHECKSUMS = {
    CUSTOMERS.name: ("CAST(user_id AS VARCHAR)", "concat('n', event_id % 7)", "'l'", "concat('e', event_id % 3, '@x.org')", "CASE WHEN event_id % 2 = 0 THEN 'p' END", "concat('1970-01-0', 1 + event_id % 9)", "'ACTIVE'", "'GOLD'", MOMENT),
    ADDRESSES.name: ("CAST(event_id AS VARCHAR)", "CAST(user_id AS VARCHAR)", "CASE event_id % 3 WHEN 0 THEN 'HOME' WHEN 1 THEN 'SHIPPING' ELSE 'BILLING' END", "concat('l', event_id)", "CASE WHEN event_id % 3 = 0 THEN 'z' END", "concat('c', event_id % 5)", "'S'", "'1'", "'NL'", "CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END", MOMENT),
    CONSENTS.name: ("CAST(event_id AS VARCHAR)", "CAST(user_id AS VARCHAR)", "CASE WHEN event_id % 2 = 0 THEN 'EMAIL' ELSE 'SMS' END", "CASE WHEN event_id % 3 = 0 THEN 'true' ELSE 'false' END", MOMENT),
}
SHORT = {CUSTOMERS.name: "customers", ADDRESSES.name: "addresses", CONSENTS.name: "consents"}
#: Offset of the event that the runs' cutoff falls on.
UPTO = 8000
CUTOFF = "2023-11-15 00:26:40"
KEYS = {CUSTOMERS.name: "user_id", ADDRESSES.name: "event_id", CONSENTS.name: "event_id"}
#: A column that the snapshots of every 11th key have other values in, and which field is named then.
CHANGED = {CUSTOMERS.name: ("last_name", "'other'"), ADDRESSES.name: ("city", "'other'"), CONSENTS.name: ("consent_type", "'PHONE'")}


def _sha(spec: EntitySpec) -> str:
    return f"sha256(concat_ws('||', {', '.join(map(_null, CHECKSUMS[spec.name]))}))"


def _entity_queries(spec: EntitySpec) -> None:
    name, key = SHORT[spec.name], KEYS[spec.name]
    live = f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY event_id DESC) AS place FROM {{events}} WHERE event_id <= {UPTO}) WHERE place = 1 AND event_type <> 'error'"
    column, other = CHANGED[spec.name]
    # the snapshot lacks every 7th key and has one in 13 twice, which is left out whole
    taken = f"SELECT * FROM ({live}) WHERE {key} % 7 <> 0 UNION ALL SELECT * FROM ({live}) WHERE {key} % 7 <> 0 AND {key} % 13 = 0"
    over = {column: f"CASE WHEN {key} % 11 = 0 THEN {other} ELSE {_entity_rows(spec)[column][1]} END"}

    if spec is not CUSTOMERS:
        first = "address_type" if spec is ADDRESSES else "consent_type"
        flag = spec.snapshot_booleans[0]

        @query(f"normalize_{name}", f"SELECT event_id AS {spec.key}, user_id AS customer_id, {_entity_rows(spec)[first][0]} AS {first}, {_entity_rows(spec)[flag][0]} AS {flag}, {OP} AS cdc_operation, event_id AS source_lsn, event_id AS kafka_offset, {MOMENT} AS updated_at FROM events")
        def normalize(spark: SparkSession, d: str) -> DataFrame:
            rows = entity_events(spark, d, spec)
            return rows.select(spec.key, "customer_id", first, flag, "cdc_operation", "source_lsn", "kafka_offset", F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("updated_at"))

    @query(f"checksum_{name}", f"SELECT {key} AS {spec.key}, {_sha(spec)} AS checksum FROM ({live.format(events='events')})")
    def checksum(spark: SparkSession, d: str) -> DataFrame:
        rows = entity_snapshot(spark, d, spec, live)
        return rows.select(spec.key, reconcile.row_checksum(spec.checksum).alias("checksum"))

    @query(f"snapshot_state_{name}", f"SELECT {key} AS {spec.key}, '{spec.name}_snapshot_20231115' AS batch_id, '' AS errors FROM ({taken.format(events='events')}) WHERE {key} % 13 <> 0 UNION ALL SELECT {key}, '{spec.name}_snapshot_20231115', 'DUPLICATE_{spec.key.upper()}' FROM ({taken.format(events='events')}) WHERE {key} % 13 = 0")
    def snapshot_state(spark: SparkSession, d: str) -> DataFrame:
        rows = snapshots.with_metadata(entity_snapshot(spark, d, spec, taken), spec.name, CUTOFF)
        good, wrong = snapshots.validated(rows, spec, CUTOFF)
        return good.select(spec.key, "batch_id", F.lit("").alias("errors")).unionAll(wrong.select(spec.key, "batch_id", F.array_join("snapshot_errors", ",")))

    business = [("MISSING_CUSTOMER_ID", "user_id % 4 = 0")] if spec is not CUSTOMERS else [("MISSING_LAST_NAME", "user_id % 4 = 0")]
    broken = {"customer_id": "CASE WHEN user_id % 4 <> 0 THEN user_id END"} if spec is not CUSTOMERS else {"last_name": "CASE WHEN user_id % 4 <> 0 THEN 'l' ELSE ' ' END"}
    if spec is ADDRESSES:
        business += [("INVALID_ADDRESS_TYPE", "event_id % 5 = 0"), ("MISSING_CITY", "event_id % 6 = 0"), ("MISSING_IS_PRIMARY", "event_id % 9 = 0")]
        broken |= {"address_type": "CASE WHEN event_id % 5 = 0 THEN 'CAVE' ELSE ' home ' END", "city": "CASE WHEN event_id % 6 = 0 THEN '' ELSE 'c' END", "is_primary": "CASE WHEN event_id % 9 = 0 THEN 'maybe' ELSE ' TRUE ' END"}
    elif spec is CONSENTS:
        business += [("MISSING_CONSENT_TYPE", "event_id % 5 = 0"), ("MISSING_GRANTED", "event_id % 9 = 0")]
        broken |= {"consent_type": "CASE WHEN event_id % 5 = 0 THEN ' ' ELSE 'SMS' END", "granted": "CASE WHEN event_id % 9 = 0 THEN '2' ELSE 'f' END"}

    @query(f"snapshot_rules_{name}", f"SELECT {key} AS {spec.key}, concat_ws(',', {', '.join(_case(*r) for r in business)}) AS errors FROM ({live.format(events='events')})")
    def snapshot_rules(spark: SparkSession, d: str) -> DataFrame:
        return snapshots.tagged(entity_snapshot(spark, d, spec, live, **broken), spec, CUTOFF).select(spec.key, F.array_join("snapshot_errors", ",").alias("errors"))

    def run(spark: SparkSession, d: str) -> ReconciliationTables:
        """A run at the cutoff over the entity's history and such a snapshot."""
        top = workspace.folder(spark)
        tables = ReconciliationTables(*(VersionedTable(spark, f"{top}/{n}", *((spec.key,), 16) if n == "expected" else ()) for n in ("history", "expected", "metadata", "summary", "detail")))
        silver.write_events(tables.history, entity_events(spark, d, spec))
        reconcile_snapshot(entity_snapshot(spark, d, spec, taken, **over), spec, tables, CUTOFF, 4, "run")
        return tables

    rows = live.format(events="events")
    missing, changed = f"({key} % 7 = 0 OR {key} % 13 = 0)", f"{key} % 11 = 0 AND NOT ({key} % 7 = 0 OR {key} % 13 = 0)"

    @query(f"recon_detail_{name}", f"SELECT {key} AS {spec.key}, 'MISSING_IN_SNAPSHOT' AS reconciliation_status, '' AS mismatch_columns, 'run' AS reconciliation_run_id, '{spec.name}' AS entity_name, true AS cdc_present, NULL AS snapshot_present FROM ({rows}) WHERE {missing} UNION ALL SELECT {key}, 'CHECKSUM_MISMATCH', {{fields}}, 'run', '{spec.name}', true, true FROM ({rows}) WHERE {changed}".replace("{fields}", f"'{_changed_fields(spec)}'"))
    def detail(spark: SparkSession, d: str) -> DataFrame:
        return run(spark, d).detail.read().select(spec.key, "reconciliation_status", F.array_join("mismatch_columns", ",").alias("mismatch_columns"), "reconciliation_run_id", "entity_name", "cdc_present", "snapshot_present")

    @query(
        f"recon_summary_{name}",
        f"""SELECT count(*) FILTER (NOT {missing}) AS snapshot_row_count, count(*) AS cdc_row_count, count(*) FILTER ({missing} OR {changed}) AS exception_count, CAST(0 AS BIGINT) AS missing_in_cdc_count, count(*) FILTER ({missing}) AS missing_in_snapshot_count,
        count(*) FILTER ({changed}) AS checksum_mismatch_count, count(*) FILTER (NOT {missing} AND NOT ({changed})) AS matched_row_count, 'COMPLETED_WITH_EXCEPTIONS' AS overall_status FROM ({rows})""",
    )
    def summary(spark: SparkSession, d: str) -> DataFrame:
        return run(spark, d).summary.read().select(*SUMMARY)


def _changed_fields(spec: EntitySpec) -> str:
    """Fields that differ by value in a changed row: the changed one, and the customers' email, which is equal once normalised only."""
    names = [c for c in spec.compare if c == CHANGED[spec.name][0] or spec is CUSTOMERS and c == "email"]
    return ",".join(f"{c.upper()}_MISMATCH" for c in names)


for _spec in (CUSTOMERS, ADDRESSES, CONSENTS):
    _entity_queries(_spec)


def _sums(side: str, table: str) -> str:
    parts = ", ':', ".join(f"CAST(sum(CAST(CAST('0x' || substr(h, {at}, 15) AS BIGINT) AS HUGEINT)) AS VARCHAR)" for at in (1, 16, 31, 46))
    return f"SELECT CAST(k % {BUCKETS} AS INT) + 1 AS bucket_id, count(k) AS {side}_row_count, concat({parts}) AS {side}_checksum FROM {table} GROUP BY 1"


@query("recon_bucket_digests", f"{SIDES}, a AS ({_sums('snapshot', 'sn')}), b AS ({_sums('cdc', 'st')}) SELECT coalesce(a.bucket_id, b.bucket_id) AS bucket_id, snapshot_row_count, snapshot_checksum, cdc_row_count, cdc_checksum FROM a FULL OUTER JOIN b ON a.bucket_id = b.bucket_id")
def recon_bucket_digests(spark: SparkSession, d: str) -> DataFrame:
    """The digest that runs use."""
    side = lambda df, name: reconcile.checksums(df, "k", CHECKSUM, BUCKETS, name, by_value=True)
    return reconcile.compare_buckets(side(order_snapshot(spark, d), "snapshot"), side(order_state(spark, d), "cdc"), "k").drop("reconciliation_status")


@query("recon_hash_buckets", "SELECT o_orderkey AS k, true AS in_range, true AS same_on_both_sides FROM orders WHERE o_orderkey % 83 <> 0 AND o_orderkey % 97 <> 0")
def recon_hash_buckets(spark: SparkSession, d: str) -> DataFrame:
    """The hash has no SQL on the other side; that every key has one bucket, the same on both sides, has."""
    side = lambda df, name: reconcile.checksums(df, "k", CHECKSUM, BUCKETS, name).select("k", F.col("bucket_id").alias(name))
    both = side(order_snapshot(spark, d), "a").join(side(order_state(spark, d), "b"), "k")
    return both.select("k", F.col("a").between(1, BUCKETS).alias("in_range"), (F.col("a") == F.col("b")).alias("same_on_both_sides"))


@query("recon_side_columns", f"{SIDES} SELECT coalesce(sn.k, st.k) AS k, sn.k IS NOT NULL AS snapshot_present, st.k IS NOT NULL AS cdc_present, sn.prio AS snapshot_prio, st.prio AS cdc_prio, sn.cents AS snapshot_cents, st.cents AS cdc_cents FROM sn FULL OUTER JOIN st ON sn.k = st.k")
def recon_side_columns(spark: SparkSession, d: str) -> DataFrame:
    here = lambda c: F.coalesce(F.col(c), F.lit(False)).alias(c)
    return _rows(spark, d).select("k", here("snapshot_present"), here("cdc_present"), "snapshot_prio", "cdc_prio", "snapshot_cents", "cdc_cents")


@query("recon_run_metadata", f"{SIDES} SELECT k, 'run' AS reconciliation_run_id, 'orders' AS entity_name, '{T2}' AS snapshot_as_of FROM r WHERE reconciliation_status <> 'MATCH'")
def recon_run_metadata(spark: SparkSession, d: str) -> DataFrame:
    return reconcile.with_run(_exceptions(spark, d), T2, "orders", "run").select("k", "reconciliation_run_id", "entity_name", F.date_format("snapshot_as_of", "yyyy-MM-dd HH:mm:ss").alias("snapshot_as_of"))


@query("catalog_table", "SELECT o_orderkey AS k, o_orderstatus AS status FROM orders")
def catalog_table(spark: SparkSession, d: str) -> DataFrame:
    """A versioned table saved into the session's catalog and read by its name."""
    top = workspace.folder(spark)
    table = VersionedTable(spark, f"{top}/versions")
    table.overwrite(order_state(spark, d).select("k", "status"))
    table.overwrite(spark.read.parquet(f"{d}/orders.parquet").selectExpr("o_orderkey AS k", "o_orderstatus AS status"))
    table.save_as("tidemark_orders", f"{top}/files")
    return spark.table("tidemark_orders")


@query("compacted_table", "SELECT event_id AS k, event_type AS v FROM events")
def compacted_table(spark: SparkSession, d: str) -> DataFrame:
    """Many appends, compacted, their old parts removed."""
    table = VersionedTable(spark, workspace.folder(spark), ("k",), 2)
    rows = spark.read.parquet(f"{d}/events.parquet").selectExpr("event_id AS k", "event_type AS v")
    for i in range(3):
        table.append(rows.where(F.col("k") % 3 == i))
    table.compact(bucket_rows=1000, small_parts=2)
    table.vacuum()
    return table.read()


@query("silver_log_counts", f"SELECT count(*) FILTER ({GOOD}) AS accepted, CAST(0 AS BIGINT) AS rejected, count(*) FILTER (event_id % 17 <> 0 AND event_id % 50 = 0) AS quarantined FROM events")
def silver_log_counts(spark: SparkSession, d: str) -> DataFrame:
    top = workspace.folder(spark)
    counts = silver.process_batch(change_log.bronze_columns(records(spark, d, JOB_JSON)), CUSTOMERS, silver.SilverTables.at(spark, lambda name: f"{top}/{name}", CUSTOMERS.key, 16))
    return spark.range(1).select(*(F.lit(counts[c]).cast("long").alias(c) for c in ("accepted", "rejected", "quarantined")))


#: As JSON, with statuses that the rules accept.
JOB_JSON = JSON.replace("upper(event_type)", "'ACTIVE'")
ORACLES["silver_microbatch"] = ORACLES["stream_bronze_to_silver"] = (
    f"SELECT customer_id, kafka_offset FROM (SELECT user_id AS customer_id, event_id AS kafka_offset, event_type FROM events WHERE {GOOD} QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1) WHERE event_type <> 'error'"
)
