"""Quality rules of the three entities: exact codes, in order."""

from __future__ import annotations

import pytest

from tidemark.entities import ADDRESSES, CONSENTS, CUSTOMERS
from tidemark.operators import rules
from tidemark.plans.silver import tagged
from tidemark.sources import snapshots

CDC = {"cdc_operation": "u", "source_lsn": 1, "kafka_topic": "t", "kafka_partition": 0, "kafka_offset": 1}
GOOD = {
    CUSTOMERS.name: {"customer_id": 1, "first_name": "a", "last_name": "b", "email": "e", "phone_number": None, "date_of_birth": None, "status": "ACTIVE", "segment": "GOLD"},
    ADDRESSES.name: {"address_id": 1, "customer_id": 2, "address_type": "HOME", "address_line_1": "l", "city": "c", "postal_code": "p", "country": "x", "is_primary": True},
    CONSENTS.name: {"consent_id": 1, "customer_id": 2, "consent_type": "EMAIL", "granted": False},
}
KINDS = {"customer_id": "long", "address_id": "long", "consent_id": "long", "source_lsn": "long", "kafka_offset": "long", "kafka_partition": "int", "is_primary": "boolean", "granted": "boolean"}


def errors(spark, spec, **over):
    row = {**GOOD[spec.name], **CDC, **over}
    schema = ", ".join(f"{c} {KINDS.get(c, 'string')}" for c in row)
    df = spark.createDataFrame([tuple(row.values())], schema)
    if "date_of_birth" in row:
        df = df.withColumn("date_of_birth", df["date_of_birth"].cast("date"))
    return tagged(df, spec).first()["dq_errors"]


CASES = [
    (CUSTOMERS, {}, []),
    (CUSTOMERS, {"cdc_operation": "x"}, ["INVALID_CDC_OPERATION"]),
    (CUSTOMERS, {"cdc_operation": None, "status": None}, ["INVALID_CDC_OPERATION", "INVALID_STATUS"]),
    (CUSTOMERS, {"first_name": "  ", "last_name": None}, ["MISSING_FIRST_NAME", "MISSING_LAST_NAME"]),
    (CUSTOMERS, {"email": None, "phone_number": " "}, ["MISSING_CONTACT_INFO"]),
    (CUSTOMERS, {"email": None, "phone_number": "1"}, []),
    (CUSTOMERS, {"date_of_birth": "2999-01-01"}, ["FUTURE_DATE_OF_BIRTH"]),
    (CUSTOMERS, {"status": "active", "segment": "VIP"}, ["INVALID_STATUS", "INVALID_SEGMENT"]),
    (CUSTOMERS, {"cdc_operation": "d", "first_name": None, "status": None, "customer_id": None}, ["MISSING_CUSTOMER_ID"]),
    (CUSTOMERS, {"cdc_operation": "d", "source_lsn": None}, ["MISSING_SOURCE_LSN"]),
    (CUSTOMERS, {"kafka_topic": None, "kafka_partition": None, "kafka_offset": None}, ["MISSING_KAFKA_TOPIC", "MISSING_KAFKA_PARTITION", "MISSING_KAFKA_OFFSET"]),
    (ADDRESSES, {}, []),
    (ADDRESSES, {"address_type": " home ", "is_primary": None, "customer_id": None}, ["MISSING_CUSTOMER_ID", "INVALID_ADDRESS_TYPE", "MISSING_IS_PRIMARY"]),
    (ADDRESSES, {"address_line_1": " ", "city": None, "postal_code": "", "country": None}, ["MISSING_ADDRESS_LINE_1", "MISSING_CITY", "MISSING_POSTAL_CODE", "MISSING_COUNTRY"]),
    (ADDRESSES, {"cdc_operation": "d", "address_id": None, "city": None}, ["MISSING_ADDRESS_ID"]),
    (CONSENTS, {}, []),
    (CONSENTS, {"consent_type": "OTHER"}, []),
    (CONSENTS, {"customer_id": None, "consent_type": " ", "granted": None}, ["MISSING_CUSTOMER_ID", "MISSING_CONSENT_TYPE", "MISSING_GRANTED"]),
    (CONSENTS, {"cdc_operation": "d", "consent_id": None, "granted": None}, ["MISSING_CONSENT_ID"]),
]


@pytest.mark.parametrize(("spec", "over", "want"), CASES)
def test_codes(spark, spec, over, want):
    assert errors(spark, spec, **over) == want


def test_split(spark):
    df = spark.createDataFrame([(1, []), (2, ["A", "B"])], "k int, dq_errors array<string>")
    assert [r["k"] for r in rules.valid(df).collect()] == [1] and "dq_errors" not in rules.valid(df).columns
    row = rules.quarantine(df).first()
    assert (row["k"], row["dq_error_count"]) == (2, 2) and row["quarantined_at"] is not None


def test_snapshot_drops_all_rows_of_a_repeated_key_and_says_why(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("address_id,customer_id,address_type,address_line_1,address_line_2,city,state,postal_code,country,is_primary,created_at,updated_at\n" + "".join(f"{k},1, home ,l,,c,,p,x,{flag},2024-01-01 00:00:00,2024-01-01 00:00:00\n" for k, flag in ((1, "T"), (2, "0"), (2, "0"), (3, "maybe"), ("x", "t"))))
    rows = snapshots.load(spark, str(path), ADDRESSES)
    good, bad = snapshots.validated(rows, ADDRESSES, "2024-01-20 00:00:00")
    assert [(r["address_id"], r["is_primary"]) for r in good.collect()] == [(1, True)]
    assert sorted(tuple(r["snapshot_errors"]) for r in bad.collect()) == [("DUPLICATE_ADDRESS_ID",), ("DUPLICATE_ADDRESS_ID",), ("MISSING_ADDRESS_ID",), ("MISSING_IS_PRIMARY",)]
