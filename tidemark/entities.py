"""What differs between the entities, as data: schemas, event columns, rules, checksum expressions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql.types import StructType

from tidemark.functions.schema import struct
from tidemark.operators.rules import Rule, blank, not_in

# fixed values: operations, and the values that the source allows
OPERATIONS = ("c", "u", "r", "d")
STATUSES, SEGMENTS, ADDRESS_TYPES = ("ACTIVE", "INACTIVE", "SUSPENDED"), ("STANDARD", "GOLD", "PREMIUM"), ("HOME", "SHIPPING", "BILLING")


@dataclass(frozen=True)
class EntitySpec:
    name: str
    key: str
    topic_setting: str
    snapshot_folder: str
    record_schema: StructType
    event_columns: dict[str, str]
    cdc_rules: tuple[Rule, ...]
    business_rules: tuple[Rule, ...]
    snapshot_schema: StructType
    snapshot_rules: Callable[[str], tuple[Rule, ...]]
    checksum: tuple[str, ...]
    compare: tuple[str, ...]
    snapshot_booleans: tuple[str, ...] = ()


def cdc_rules(key: str) -> tuple[Rule, ...]:
    missing = (key, "kafka_topic", "kafka_partition", "kafka_offset", "source_lsn")
    return (Rule("INVALID_CDC_OPERATION", not_in("cdc_operation", OPERATIONS)), *(Rule(f"MISSING_{c.upper()}", f"{c} IS NULL") for c in missing))


def _instant(name: str) -> str:
    return f"try_to_timestamp(r.{name})"


def _second(name: str) -> str:
    return f"date_format({name}, 'yyyy-MM-dd HH:mm:ss.SSSSSS')"


_names = (Rule("MISSING_FIRST_NAME", blank("first_name")), Rule("MISSING_LAST_NAME", blank("last_name")), Rule("MISSING_CONTACT_INFO", f"{blank('email')} AND {blank('phone_number')}"))
_kinds = (Rule("INVALID_STATUS", not_in("status", STATUSES)), Rule("INVALID_SEGMENT", not_in("segment", SEGMENTS)))


def _customer_rules(today: str) -> tuple[Rule, ...]:
    return (*_names, Rule("FUTURE_DATE_OF_BIRTH", f"date_of_birth > {today}"), *_kinds)


CUSTOMERS = EntitySpec(
    name="customers",
    key="customer_id",
    topic_setting="customers_topic",
    snapshot_folder="customer",
    record_schema=struct("customer_id bigint, first_name string, last_name string, email string, phone_number string, date_of_birth bigint, status string, segment string, created_at string, updated_at string"),
    event_columns={
        "customer_id": "r.customer_id", "first_name": "r.first_name", "last_name": "r.last_name", "email": "r.email", "phone_number": "r.phone_number",
        # days since 1970; what doesn't fit is null rather than an error that would stop the batch
        "date_of_birth": "date_add(DATE'1970-01-01', try_cast(r.date_of_birth AS INT))", "status": "r.status", "segment": "r.segment", "created_at": _instant("created_at"), "updated_at": _instant("updated_at"),
    },
    cdc_rules=cdc_rules("customer_id"),
    business_rules=_customer_rules("current_date()"),
    snapshot_schema=struct("customer_id bigint, first_name string, last_name string, email string, phone_number string, date_of_birth date, status string, segment string, created_at timestamp, updated_at timestamp"),
    snapshot_rules=lambda as_of: (Rule("MISSING_CUSTOMER_ID", "customer_id IS NULL"), *_customer_rules(f"to_date('{as_of}')")),
    checksum=("CAST(customer_id AS STRING)", "trim(first_name)", "trim(last_name)", "lower(trim(email))", "trim(phone_number)", "date_format(date_of_birth, 'yyyy-MM-dd')", "upper(trim(status))", "upper(trim(segment))", _second("updated_at")),
    compare=("first_name", "last_name", "email", "phone_number", "date_of_birth", "status", "segment", "updated_at"),
)

_ADDRESS_TEXT = ("address_type", "address_line_1", "address_line_2", "city", "state", "postal_code", "country")


def _address_rules(address_type: str) -> tuple[Rule, ...]:
    wrong_type = f"(address_type IS NULL OR {address_type} NOT IN {ADDRESS_TYPES})"
    filled = (Rule(f"MISSING_{c.upper()}", blank(c)) for c in ("address_line_1", "city", "postal_code", "country"))
    return (Rule("MISSING_CUSTOMER_ID", "customer_id IS NULL"), Rule("INVALID_ADDRESS_TYPE", wrong_type), *filled, Rule("MISSING_IS_PRIMARY", "is_primary IS NULL"))


ADDRESSES = EntitySpec(
    name="customer_addresses",
    key="address_id",
    topic_setting="customer_addresses_topic",
    snapshot_folder="customer_addresses",
    record_schema=struct(f"address_id bigint, customer_id bigint, {', '.join(f'{c} string' for c in _ADDRESS_TEXT)}, is_primary boolean, created_at string, updated_at string"),
    event_columns={c: f"r.{c}" for c in ("address_id", "customer_id", *_ADDRESS_TEXT, "is_primary")} | {c: _instant(c) for c in ("created_at", "updated_at")},
    cdc_rules=cdc_rules("address_id"),
    business_rules=_address_rules("address_type"),
    snapshot_schema=struct(f"address_id bigint, customer_id bigint, {', '.join(f'{c} string' for c in _ADDRESS_TEXT)}, is_primary string, created_at timestamp, updated_at timestamp"),
    # a snapshot's type may be spaced and in any case, an event's may not
    snapshot_rules=lambda as_of: (Rule("MISSING_ADDRESS_ID", "address_id IS NULL"), *_address_rules("upper(trim(address_type))")),
    checksum=("CAST(address_id AS STRING)", "CAST(customer_id AS STRING)", "upper(trim(address_type))", "trim(address_line_1)", "trim(address_line_2)", "trim(city)", "trim(state)", "trim(postal_code)", "upper(trim(country))", "CAST(is_primary AS STRING)", _second("updated_at")),
    compare=("customer_id", *_ADDRESS_TEXT, "is_primary", "updated_at"),
    snapshot_booleans=("is_primary",),
)

_consent_rules = (Rule("MISSING_CUSTOMER_ID", "customer_id IS NULL"), Rule("MISSING_CONSENT_TYPE", blank("consent_type")), Rule("MISSING_GRANTED", "granted IS NULL"))

CONSENTS = EntitySpec(
    name="customer_consents",
    key="consent_id",
    topic_setting="customer_consents_topic",
    snapshot_folder="customer_consents",
    record_schema=struct("consent_id bigint, customer_id bigint, consent_type string, granted boolean, created_at string, updated_at string"),
    event_columns={c: f"r.{c}" for c in ("consent_id", "customer_id", "consent_type", "granted")} | {c: _instant(c) for c in ("created_at", "updated_at")},
    cdc_rules=cdc_rules("consent_id"),
    business_rules=_consent_rules,
    snapshot_schema=struct("consent_id bigint, customer_id bigint, consent_type string, granted string, created_at timestamp, updated_at timestamp"),
    snapshot_rules=lambda as_of: (Rule("MISSING_CONSENT_ID", "consent_id IS NULL"), *_consent_rules),
    checksum=("CAST(consent_id AS STRING)", "CAST(customer_id AS STRING)", "upper(trim(consent_type))", "CAST(granted AS STRING)", _second("updated_at")),
    compare=("customer_id", "consent_type", "granted", "updated_at"),
    snapshot_booleans=("granted",),
)

ENTITIES = {e.name: e for e in (CUSTOMERS, ADDRESSES, CONSENTS)}
