"""Event shapes, operational table definitions and their declared rules.

Rules (NOT NULL, VARCHAR lengths, keys, UNIQUE sets, references, one-entity
CHECK, formats) are data here, so the validation operators are generic and
the constraint report scans each table once.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# --- fixed values: must equal the reference's for equal results -------------
# Minor-unit exponent per currency; any other code uses 2.
CURRENCY_MINOR_UNITS = {
    "USD": 2, "EGP": 2, "EUR": 2, "GBP": 2, "JPY": 0, "AUD": 2, "CAD": 2, "CHF": 2,
}
DEFAULT_MINOR_UNITS = 2
# Event type -> status written with it.
EVENT_STATUS = {
    "payment_intent_created": "pending",
    "payment_intent_authorized": "authorized",
    "payment_intent_failed": "failed",
    "capture_succeeded": "captured",
    "settlement_recorded": "settled",
    "refund_recorded": "refunded",
    "chargeback_received": "chargeback",
}
# Event type -> entity table it is written to.
EVENT_TARGET = {
    "payment_intent_created": "payment_intents",
    "payment_intent_authorized": "payment_intents",
    "payment_intent_failed": "payment_intents",
    "settlement_recorded": "payment_intents",
    "capture_succeeded": "charges",
    "refund_recorded": "refunds",
    "chargeback_received": "chargebacks",
}
# Allowed status transitions (START = first event of a transaction).
ALLOWED_TRANSITIONS = [
    ("START", "pending"),
    ("pending", "authorized"), ("pending", "failed"),
    ("authorized", "captured"),
    ("captured", "settled"), ("captured", "refunded"), ("captured", "chargeback"),
    ("refunded", "settled"), ("refunded", "refunded"), ("refunded", "chargeback"),
]
# Older event shapes: v0 type names -> current event types.
V0_EVENT_TYPES = {
    "AUTHORIZATION": "payment_intent_authorized",
    "CAPTURE": "capture_succeeded",
    "REFUND": "refund_recorded",
    "CHARGEBACK": "chargeback_received",
}
# v1 statuses -> current event types (both initial statuses mean "created").
V1_STATUS_EVENT_TYPES = {
    "payment_intent_created": "payment_intent_created",
    "pending": "payment_intent_created",
    "authorized": "payment_intent_authorized",
    "failed": "payment_intent_failed",
    "captured": "capture_succeeded",
    "settled": "settlement_recorded",
    "refunded": "refund_recorded",
    "chargeback": "chargeback_received",
}
EMAIL_DOMAIN = "@example.com"
UUID_PATTERN = "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
# ISO-8601 forms: calendar or week date, each extended or basic, and a time of one
# to three parts with a fraction and an offset; anything else parses to null.
ISO_TS_PATTERN = (r"^(\d{4}-\d{2}-\d{2}|\d{8}|\d{4}-W\d{2}(-[1-7])?|\d{4}W\d{2}[1-7]?)"
                  r"([T ](\d{2}(:\d{2}(:\d{2}([.,]\d+)?)?)?|\d{4}(\d{2}([.,]\d+)?)?)(Z|[+-]\d{2}(:?\d{2})?)?)?$")
# The form that the parser reads itself, the week date, and what turns the others into it.
ISO_USUAL = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?(Z|[+-]\d{2}:?\d{2})?)?)?$"
ISO_WEEK = r"^(\d{4})-?W(\d{2})-?([1-7])?"
ISO_REWRITES = [
    (r"^(\d{4})(\d{2})(\d{2})(?=[T ]|$)", "$1-$2-$3"),
    (r"([T ]\d{2})(\d{2})(\d{2})(?=[.,Z+-]|$)", "$1:$2:$3"),
    (r"([T ]\d{2})(\d{2})(?=[Z+-]|$)", "$1:$2"),
    (r"([T ]\d{2})(?=[Z+-]|$)", "$1:00"),
    (r"([T ]\d{2}:\d{2})(?=[Z+-])", "$1:00"),
    (r",", "."),
    (r"([T ].*[+-]\d{2})(\d{2})$", "$1:$2"),
    (r"([T ].*[+-]\d{2})$", "$1:00"),
]
# -----------------------------------------------------------------------------

INTENT_EVENT_TYPES = [e for e, t in EVENT_TARGET.items() if t == "payment_intents"]
EVENT_TYPES = list(EVENT_STATUS)
# Lifecycle step of each event type: the tie-break after ingestion time.
EVENT_STEP = {
    "payment_intent_created": 1,
    "payment_intent_authorized": 2,
    "payment_intent_failed": 2,
    "capture_succeeded": 3,
    "settlement_recorded": 4,
    "refund_recorded": 4,
    "chargeback_received": 4,
}

K2 = ["transaction_id", "idempotency_key"]
K3 = K2 + ["event_type"]
# Arrival order. ``ord`` is the lifecycle step and ``copy_no`` the delivery
# copy (0 original, 1 exact copy, 2 retry); readers of real feeds fill both.
# Steps repeat (a refund and a chargeback of one instant), so the id decides last.
ARRIVAL_ORDER = ["ingestion_timestamp", "ord", "copy_no", "event_id"]

# Raw event as the producer emits it (one flat JSON object).
RAW_EVENT_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("idempotency_key", T.StringType()),
    T.StructField("intent_id", T.StringType()),
    T.StructField("charge_id", T.StringType()),
    T.StructField("refund_id", T.StringType()),
    T.StructField("chargeback_id", T.StringType()),
    T.StructField("retry_attempt", T.IntegerType()),
    T.StructField("merchant_id", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("currency", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("source_system", T.StringType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("original_transaction_timestamp", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("event_id", T.StringType()),
    T.StructField("event_timestamp", T.StringType()),
    T.StructField("ingestion_timestamp", T.StringType()),
    T.StructField("failure_code", T.StringType()),
    T.StructField("refund_reason", T.StringType()),
    T.StructField("is_partial", T.BooleanType()),
    T.StructField("reason", T.StringType()),
])
RAW_EVENT_FIELDS = [f.name for f in RAW_EVENT_SCHEMA.fields]
# Fields the producer always writes (the last three are read, never set).
PRODUCER_FIELDS = RAW_EVENT_FIELDS[:21]

# v0 Kafka shape and its late variant share one schema (late rows leave most null).
V0_EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("transaction_id", T.StringType()),
    T.StructField("merchant_id", T.StringType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("currency", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("source_system", T.StringType()),
    T.StructField("processor_reference", T.StringType()),
    T.StructField("event_timestamp", T.StringType()),
    T.StructField("ingestion_timestamp", T.StringType()),
    T.StructField("metadata_note", T.StringType()),
])

# v1 shape: no event_type, int user_id, a single ``timestamp``.
V1_EVENT_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("idempotency_key", T.StringType()),
    T.StructField("merchant_id", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("currency", T.StringType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("country", T.StringType()),
    T.StructField("source_system", T.StringType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("event_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("failure_code", T.StringType()),
])


@dataclass(frozen=True)
class Column:
    name: str
    dtype: T.DataType
    max_len: int | None = None
    not_null: bool = False


@dataclass(frozen=True)
class Table:
    name: str
    columns: list[Column]
    key: list[str]
    unique: list[list[str]] = field(default_factory=list)
    references: list[tuple[str, str, str]] = field(default_factory=list)  # (col, table, col)
    one_entity: list[str] | None = None
    uuid_columns: list[str] = field(default_factory=list)
    json_columns: list[str] = field(default_factory=list)

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.dtype, True) for c in self.columns])

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]


# --- fixed values: columns, lengths, keys and references of the operational tables ---
S, L, B, TS = T.StringType(), T.LongType(), T.BooleanType(), T.TimestampType()


def _c(name, dtype, n=None, nn=False):
    return Column(name, dtype, n, nn)


TABLES: dict[str, Table] = {t.name: t for t in [
    Table("merchants", [
        _c("merchant_id", S, 50, True), _c("merchant_name", S, 50, True), _c("country", S, 2),
        _c("created_at", TS), _c("updated_at", TS)], key=["merchant_id"]),
    Table("users", [
        _c("user_id", S, 50, True), _c("email", S, 255, True),
        _c("created_at", TS), _c("updated_at", TS)], key=["user_id"], unique=[["email"]]),
    Table("payment_intents", [
        _c("intent_id", S, 50, True), _c("transaction_id", S, 50, True),
        _c("idempotency_key", S, 100, True), _c("user_id", S, 50), _c("merchant_id", S, 50),
        _c("amount_minor", L, None, True), _c("currency", S, 3, True), _c("status", S, 50, True),
        _c("source_system", S, 50), _c("created_at", TS), _c("updated_at", TS)],
        key=["intent_id"], unique=[K2],
        references=[("user_id", "users", "user_id"), ("merchant_id", "merchants", "merchant_id")]),
    Table("charges", [
        _c("charge_id", S, 50, True), _c("transaction_id", S, 50, True),
        _c("idempotency_key", S, 100, True), _c("intent_id", S, 50),
        _c("amount_minor", L, None, True), _c("status", S, 50, True), _c("currency", S, 3, True),
        _c("payment_method", S, 50), _c("source_system", S, 50),
        _c("created_at", TS), _c("updated_at", TS)],
        key=["charge_id"], unique=[K2],
        references=[("intent_id", "payment_intents", "intent_id")]),
    Table("refunds", [
        _c("refund_id", S, 50, True), _c("transaction_id", S, 50, True),
        _c("idempotency_key", S, 100, True), _c("charge_id", S, 50),
        _c("amount_minor", L, None, True), _c("currency", S, 3, True), _c("refund_reason", S, 100),
        _c("is_partial", B), _c("status", S, 50, True), _c("source_system", S, 50),
        _c("created_at", TS), _c("updated_at", TS)],
        key=["refund_id"], unique=[K2],
        references=[("charge_id", "charges", "charge_id")]),
    Table("chargebacks", [
        _c("chargeback_id", S, 50, True), _c("charge_id", S, 50),
        _c("amount_minor", L, None, True), _c("reason", S, 100), _c("filed_at", TS),
        _c("status", S, 50), _c("created_at", TS), _c("updated_at", TS)],
        key=["chargeback_id"],
        references=[("charge_id", "charges", "charge_id")]),
    Table("payment_status_history", [
        _c("event_id", S, None, True), _c("transaction_id", S, 50, True),
        _c("idempotency_key", S, 100, True), _c("intent_id", S, 50), _c("charge_id", S, 50),
        _c("refund_id", S, 50), _c("event_type", S, 50, True), _c("chargeback_id", S, 50),
        _c("status", S, 50, True), _c("event_timestamp", TS), _c("ingestion_timestamp", TS),
        _c("source_system", S, 50), _c("payload", S, None, True)],
        key=["event_id"], unique=[K3],
        references=[("intent_id", "payment_intents", "intent_id"),
                    ("charge_id", "charges", "charge_id"),
                    ("refund_id", "refunds", "refund_id"),
                    ("chargeback_id", "chargebacks", "chargeback_id")],
        one_entity=["intent_id", "charge_id", "refund_id", "chargeback_id"],
        uuid_columns=["event_id"], json_columns=["payload"]),
    Table("raw_payment_events", [
        _c("event_id", S, None, True), _c("transaction_id", S, 50, True),
        _c("idempotency_key", S, 100, True), _c("event_type", S, 50, True),
        _c("payload", S, None, True), _c("ingestion_timestamp", TS), _c("processed", B)],
        key=["event_id"], unique=[K2], uuid_columns=["event_id"], json_columns=["payload"]),
]}
# -----------------------------------------------------------------------------

HISTORY_COLUMNS = TABLES["payment_status_history"].column_names
