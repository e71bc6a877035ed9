"""Column expressions for event normalisation.

All of these are built-in Spark SQL expressions: they run inside
whole-stage codegen, need no Python worker and add no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.schemas import (
    ARRIVAL_ORDER, CURRENCY_MINOR_UNITS, DEFAULT_MINOR_UNITS, EMAIL_DOMAIN, EVENT_STATUS,
    EVENT_STEP, ISO_REWRITES, ISO_TS_PATTERN, ISO_USUAL, ISO_WEEK, PRODUCER_FIELDS, RAW_EVENT_FIELDS, V0_EVENT_SCHEMA,
    V0_EVENT_TYPES, V1_EVENT_SCHEMA, V1_STATUS_EVENT_TYPES,
)


def _map_literal(mapping: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])


# --- B1 ---------------------------------------------------------------------
def minor_units(currency: Column) -> Column:
    """Minor-unit exponent of a currency code; unknown or null codes get 2."""
    return F.coalesce(F.element_at(_map_literal(CURRENCY_MINOR_UNITS), currency),
                      F.lit(DEFAULT_MINOR_UNITS))


def amount_minor(amount: Column, currency: Column) -> Column:
    """``int(round(amount * 10**scale))`` with round-half-even, as a BIGINT.

    ``rint`` rounds ties to even like Python's ``round``; ``F.round`` would
    round 2.5 to 3. Arithmetic stays in double, as in the reference. An
    infinite amount, or one beyond BIGINT, gives null (and a reject reason in
    C4) instead of failing the job.
    """
    scaled = amount * F.pow(F.lit(10.0), minor_units(currency))
    return F.when(amount.isNotNull() & ~F.isnan(amount), F.rint(scaled).try_cast("long"))


def normalise_amounts(df: DataFrame, amount: str = "amount", currency: str = "currency",
                      out: str = "amount_minor") -> DataFrame:
    return df.withColumn(out, amount_minor(F.col(amount), F.col(currency)))


# --- B2 ---------------------------------------------------------------------
def parse_iso_timestamp(text: Column) -> Column:
    """ISO-8601 text -> instant (TimestampType); null when unreadable.

    A pattern keeps Spark's lenient parser from accepting forms that the
    reference rejects (``2024``, ``2024-01``, padded text). Text in the usual
    extended form goes to the parser as it is; basic dates and times, week
    dates, hours alone and comma fractions are first written in that form. A
    missing offset is read as UTC (the session zone).

    The rare forms are handled inside a lambda: lambdas stay out of the
    generated code, which with all rewrites in it grows beyond what the JVM
    compiles, and then every row pays for them (b2_timestamps at sf0.1: 3.1 s
    with the rewrites inline, 2.4 s so, 2.3 s without any rare form).
    """
    s = text.cast("string")
    rare = F.get(F.transform(F.array(s), _usual_form), F.lit(0))
    return F.try_to_timestamp(F.when(s.rlike(ISO_USUAL), s).otherwise(rare))


def _usual_form(s: Column) -> Column:
    """A rarer ISO-8601 form written in the usual one; null for any other text."""
    fixed = s
    for pattern, new in ISO_REWRITES:
        fixed = F.regexp_replace(fixed, pattern, new)
    week = F.regexp_extract(s, ISO_WEEK, 2).cast("int")
    day = F.regexp_extract(s, ISO_WEEK, 3)
    # the fourth of January lies in week one; a week that the year does not have is unreadable
    monday = F.date_add(F.trunc(F.to_date(F.concat(F.substring(s, 1, 4), F.lit("-01-04"))), "week"), (week - 1) * 7)
    by_week = F.concat(F.date_add(monday, F.when(day == "", 0).otherwise(day.cast("int") - 1)).cast("string"),
                       F.regexp_replace(fixed, ISO_WEEK, ""))
    return (F.when(~s.rlike(ISO_TS_PATTERN), F.lit(None)).when(~s.contains("W"), fixed)
            .when(F.weekofyear(monday) == week, by_week))


def normalise_timestamps(df: DataFrame,
                         columns: Sequence[str] = ("event_timestamp", "ingestion_timestamp",
                                                   "original_transaction_timestamp")) -> DataFrame:
    """Parse ISO text columns in place. Numeric input is not text: it becomes null."""
    replace = {}
    for c in columns:
        if c not in df.columns:
            continue
        dtype = dict(df.dtypes)[c]
        if dtype == "string":
            replace[c] = parse_iso_timestamp(F.col(c))
        elif dtype.startswith("timestamp"):
            replace[c] = F.col(c).cast("timestamp")
        else:
            replace[c] = F.lit(None).cast("timestamp")
    return df.withColumns(replace)


# --- B3 / B4 ----------------------------------------------------------------
def encode_payload(fields: Sequence[str] = PRODUCER_FIELDS) -> Column:
    """The whole event as one JSON object; null fields are kept, as the reference does."""
    return F.to_json(F.struct(*[F.col(f) for f in fields]), {"ignoreNullFields": "false"})


def payload_field(payload: Column, key: str) -> Column:
    """``payload->>'key'``: the field as text, or null."""
    return F.get_json_object(payload, f"$.{key}")


def payload_variant(payload: Column) -> Column:
    """The payload as VARIANT, as a JSONB column holds it; null for text that is no JSON value (:func:`is_json_value`)."""
    return F.when(is_json_value(payload), F.try_parse_json(payload))


#: Text that stands behind a payload in an array. A payload without it and without escapes cannot spell it.
_END = "~"


def is_json_value(payload: Column) -> Column:
    """Is the text one JSON value (an object, an array, a number, text, ``null``)? False for null.

    The parser stops behind the first value and accepts what follows it, so the
    text is parsed once as the first of two elements, the second being ``_END``:
    a text that closes the array or goes on with it does not leave it there. Text
    that could spell ``_END`` itself has to parse inside an array and inside an
    object instead: what would close or go on with the one breaks the other.
    An object that repeats a key is no VARIANT, and so no value.
    """
    parsed = lambda a, b: F.try_parse_json(F.concat(F.lit(a), payload, F.lit(b)))
    alone = F.try_variant_get(parsed("[", f',"{_END}"]'), "$[1]", "string") == _END
    twice = parsed("[", "]").isNotNull() & parsed('{"v":', "}").isNotNull()
    spelt = payload.contains(_END) | payload.contains("\\")
    return F.coalesce(F.when(spelt, twice).otherwise(alone), F.lit(False))


def variant_field(variant: Column, key: str, kind: str = "string") -> Column:
    """A field of a parsed payload as ``kind``; null where it is absent, null or of another kind."""
    return F.try_variant_get(variant, f"$.{key}", kind)


# --- B5 ---------------------------------------------------------------------
def user_email(user_id: Column) -> Column:
    return F.concat(user_id, F.lit(EMAIL_DOMAIN))


# --- B6 ---------------------------------------------------------------------
def default_if_absent(value: Column, key: str, present_keys: Column | None, default) -> Column:
    """``event.get(key, default)``: the default applies only when the key is absent.

    With ``present_keys`` (the message's key list, e.g. ``json_object_keys``)
    an explicit JSON null stays null. Without it the frame cannot tell the two
    apart and null counts as absent.
    """
    if present_keys is None:
        return F.coalesce(value, F.lit(default))
    return F.when(F.array_contains(present_keys, key), value).otherwise(F.lit(default))


# --- B7 ---------------------------------------------------------------------
def stable_uuid(*cols: Column | str) -> Column:
    """A UUID-formatted id from a SHA-256 of the key: a redo yields the same id."""
    h = F.sha2(F.concat_ws("|", *[F.col(c) if isinstance(c, str) else c for c in cols]), 256)
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))


# --- arrival order ------------------------------------------------------------
def event_step(event_type: Column) -> Column:
    return F.element_at(_map_literal(EVENT_STEP), event_type)


def arrival_seq(order: Sequence[str] = ARRIVAL_ORDER) -> Column:
    """Arrival order as one comparable struct (for min_by / max_by / orderBy)."""
    return F.struct(*[F.col(c) for c in order])


def normalise_events(raw: DataFrame) -> DataFrame:
    """B1 + B2 on raw deliveries: typed timestamps and ``amount_minor``.

    Adds ``ord`` / ``copy_no`` when a real feed lacks them: the lifecycle
    step of the event type and the retry counter.
    """
    df = normalise_timestamps(raw)
    df = normalise_amounts(df)
    add = {}
    if "ord" not in df.columns:
        add["ord"] = event_step(F.col("event_type"))
    if "copy_no" not in df.columns:
        add["copy_no"] = F.coalesce(F.col("retry_attempt"), F.lit(0))
    return df.withColumns(add) if add else df


# --- B10 ----------------------------------------------------------------------
def _user_text(user_id: Column) -> Column:
    return F.when(user_id.isNotNull(), F.concat(F.lit("user_"), user_id.cast("string")))


def unify_v0(v0: DataFrame) -> DataFrame:
    """v0 Kafka shape -> current raw shape.

    No status (derived from the type), no idempotency key (the transaction id
    stands in), int user ids get the ``user_`` prefix. Sparse late rows keep
    nulls where the message had nothing.
    """
    et = F.element_at(_map_literal(V0_EVENT_TYPES), F.col("event_type"))
    cols = {
        "transaction_id": F.col("transaction_id"),
        "idempotency_key": F.col("transaction_id"),
        "intent_id": F.lit(None).cast("string"),
        "charge_id": F.lit(None).cast("string"),
        "refund_id": F.lit(None).cast("string"),
        "chargeback_id": F.lit(None).cast("string"),
        "retry_attempt": F.lit(0),
        "merchant_id": F.col("merchant_id"),
        "amount": F.col("amount"),
        "currency": F.col("currency"),
        "user_id": _user_text(F.col("user_id")),
        "country": F.col("country"),
        "source_system": F.col("source_system"),
        "payment_method": F.col("payment_method"),
        "original_transaction_timestamp": F.lit(None).cast("string"),
        "event_type": et,
        "status": F.element_at(_map_literal(EVENT_STATUS), et),
        "event_id": F.col("event_id"),
        "event_timestamp": F.col("event_timestamp"),
        "ingestion_timestamp": F.col("ingestion_timestamp"),
        "failure_code": F.lit(None).cast("string"),
        "refund_reason": F.lit(None).cast("string"),
        "is_partial": F.lit(None).cast("boolean"),
        "reason": F.lit(None).cast("string"),
    }
    extra = [c for c in v0.columns if c not in V0_EVENT_SCHEMA.fieldNames()]
    return v0.select(*[cols[c].alias(c) for c in RAW_EVENT_FIELDS], *extra)


def unify_v1(v1: DataFrame) -> DataFrame:
    """v1 shape -> current raw shape: event type from status, ``timestamp`` as both times."""
    et = F.element_at(_map_literal(V1_STATUS_EVENT_TYPES), F.col("status"))
    cols = {
        "transaction_id": F.col("transaction_id"),
        "idempotency_key": F.col("idempotency_key"),
        "intent_id": F.lit(None).cast("string"),
        "charge_id": F.lit(None).cast("string"),
        "refund_id": F.lit(None).cast("string"),
        "chargeback_id": F.lit(None).cast("string"),
        "retry_attempt": F.lit(0),
        "merchant_id": F.col("merchant_id"),
        "amount": F.col("amount"),
        "currency": F.col("currency"),
        "user_id": _user_text(F.col("user_id")),
        "country": F.col("country"),
        "source_system": F.col("source_system"),
        "payment_method": F.col("payment_method"),
        "original_transaction_timestamp": F.lit(None).cast("string"),
        "event_type": et,
        "status": F.element_at(_map_literal(EVENT_STATUS), et),
        "event_id": F.col("event_id"),
        "event_timestamp": F.col("timestamp"),
        "ingestion_timestamp": F.col("timestamp"),
        "failure_code": F.col("failure_code"),
        "refund_reason": F.lit(None).cast("string"),
        "is_partial": F.lit(None).cast("boolean"),
        "reason": F.lit(None).cast("string"),
    }
    extra = [c for c in v1.columns if c not in V1_EVENT_SCHEMA.fieldNames()]
    return v1.select(*[cols[c].alias(c) for c in RAW_EVENT_FIELDS], *extra)


def unify_event_versions(current: DataFrame | None = None, v0: DataFrame | None = None,
                         v1: DataFrame | None = None) -> DataFrame:
    """Bag union of all shapes in the current shape (``unionByName``, no shuffle)."""
    parts = []
    if current is not None:
        parts.append(current)
    if v0 is not None:
        parts.append(unify_v0(v0))
    if v1 is not None:
        parts.append(unify_v1(v1))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
