"""DuckDB CTEs for the folded entity tables and the status history.

Written with ``row_number`` windows (first and last arrival per key, joined),
independent of the Spark aggregate form.
"""

from __future__ import annotations

from ledgerlake.schemas import TABLES

ORDER_ASC = "ingestion_timestamp, ord, copy_no, event_id"
ORDER_DESC = "ingestion_timestamp DESC, ord DESC, copy_no DESC, event_id DESC"

_FOLDS = {
    # table: (routed event types, key, first-wins column expressions)
    "payment_intents": (
        ["payment_intent_created", "payment_intent_authorized", "payment_intent_failed",
         "settlement_recorded"],
        ["transaction_id", "idempotency_key"],
        {"intent_id": "intent_id", "transaction_id": "transaction_id",
         "idempotency_key": "idempotency_key", "user_id": "user_id", "merchant_id": "merchant_id",
         "amount_minor": "amount_minor", "currency": "currency", "source_system": "source_system"}),
    "charges": (
        ["capture_succeeded"], ["transaction_id", "idempotency_key"],
        {"charge_id": "charge_id", "transaction_id": "transaction_id",
         "idempotency_key": "idempotency_key", "intent_id": "intent_id",
         "amount_minor": "amount_minor", "currency": "currency",
         "payment_method": "payment_method", "source_system": "source_system"}),
    "refunds": (
        ["refund_recorded"], ["transaction_id", "idempotency_key"],
        {"refund_id": "refund_id", "transaction_id": "transaction_id",
         "idempotency_key": "idempotency_key", "charge_id": "charge_id",
         "amount_minor": "amount_minor", "currency": "currency", "refund_reason": "refund_reason",
         "is_partial": "coalesce(is_partial, false)", "source_system": "source_system"}),
    "chargebacks": (
        ["chargeback_received"], ["chargeback_id"],
        {"chargeback_id": "chargeback_id", "charge_id": "charge_id",
         "amount_minor": "amount_minor", "reason": "reason", "filed_at": "ingestion_timestamp"}),
}


def fold_cte(table: str, key_override: list[str] | None = None, name: str | None = None) -> str:
    types, key, first = _FOLDS[table]
    key = key_override or key
    part = ", ".join(key)
    in_list = ", ".join(f"'{t}'" for t in types)
    on = " AND ".join(f"f.{k} = l.{k}" for k in key)
    cols = []
    for c in TABLES[table].column_names:
        if c == "status":
            cols.append("l.status AS status")
        elif c == "created_at":
            cols.append("f.ingestion_timestamp AS created_at")
        elif c == "updated_at":
            cols.append("l.ingestion_timestamp AS updated_at")
        else:
            expr = first[c]
            cols.append(f"f.{expr} AS {c}" if expr == c else f"f.fx_{c} AS {c}")
    extra = "".join(f", {e} AS fx_{c}" for c, e in first.items() if e != c)
    name = name or table
    return f"""
r_{name} AS (
  SELECT *{extra},
    row_number() OVER (PARTITION BY {part} ORDER BY {ORDER_ASC}) AS rn_f,
    row_number() OVER (PARTITION BY {part} ORDER BY {ORDER_DESC}) AS rn_l
  FROM ev WHERE event_type IN ({in_list})
), t_{name} AS (
  SELECT {", ".join(cols)}
  FROM r_{name} f JOIN r_{name} l ON {on} AND f.rn_f = 1 AND l.rn_l = 1
)"""


def first_touch_cte(table: str, key: str) -> str:
    name_col = "merchant_id AS merchant_name, CAST(NULL AS VARCHAR) AS country, " \
        if table == "merchants" else f"{key} || '@example.com' AS email, "
    return f"""
t_{table} AS (
  SELECT {key}, {name_col}ingestion_timestamp AS created_at, ingestion_timestamp AS updated_at
  FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {ORDER_ASC}) AS rn_
        FROM ev WHERE {key} IS NOT NULL AND {key} <> '') WHERE rn_ = 1
)"""


def uuid_sql(expr: str) -> str:
    h = f"sha256({expr})"
    return (f"substr({h},1,8) || '-' || substr({h},9,4) || '-' || substr({h},13,4) || '-' || "
            f"substr({h},17,4) || '-' || substr({h},21,12)")


HISTORY_CTE = f"""
t_payment_status_history AS (
  SELECT {uuid_sql("concat_ws('|', transaction_id, idempotency_key, event_type)")} AS event_id,
    transaction_id, idempotency_key,
    CASE WHEN event_type IN ('payment_intent_created','payment_intent_authorized',
                             'payment_intent_failed','settlement_recorded') THEN intent_id END
      AS intent_id,
    CASE WHEN event_type = 'capture_succeeded' THEN charge_id END AS charge_id,
    CASE WHEN event_type = 'refund_recorded' THEN refund_id END AS refund_id,
    event_type,
    CASE WHEN event_type = 'chargeback_received' THEN chargeback_id END AS chargeback_id,
    status, event_timestamp, ingestion_timestamp, source_system,
    json_object('event_id', event_id, 'transaction_id', transaction_id)::VARCHAR AS payload,
    event_id AS payload_event_id, failure_code AS payload_failure_code, amount AS payload_amount,
    ord, copy_no
  FROM dd
)"""


RAW_CTE = f"""
t_raw_payment_events AS (
  SELECT {uuid_sql("concat_ws('|', transaction_id, idempotency_key)")} AS event_id,
    transaction_id, idempotency_key, event_type,
    json_object('event_id', event_id, 'transaction_id', transaction_id)::VARCHAR AS payload,
    ingestion_timestamp, false AS processed
  FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id, idempotency_key ORDER BY {ORDER_ASC}) AS rn_
        FROM ev) WHERE rn_ = 1
)"""


def all_tables_ctes() -> str:
    parts = [fold_cte(t) for t in _FOLDS]
    parts.append(first_touch_cte("users", "user_id"))
    parts.append(first_touch_cte("merchants", "merchant_id"))
    parts.append(HISTORY_CTE)
    parts.append(RAW_CTE)
    return ",".join(p.strip("\n") for p in parts)
