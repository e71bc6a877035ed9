"""Entity-table upserts (E1-E7), routing (C2) and insert-if-absent (JN6).

The reference runs ``INSERT ... ON CONFLICT (key) DO UPDATE SET status,
updated_at`` once per event. Folded over events that is: every column from
the key's *first* arrival, ``status`` from its *last*, ``created_at`` from
the first write and ``updated_at`` from the last touch (a copy that changes
nothing still touches). ``DO NOTHING`` tables (users, merchants, the log)
keep the first row whole.

One code path does it all: each event becomes a *candidate row* of the
target table carrying ``first_seq`` = ``last_seq`` = its arrival order, and
:func:`fold_rows` folds candidates -- or already folded rows -- with
``min_by`` over ``first_seq`` and ``max_by`` over ``last_seq``. The fold is
associative and commutative, so a batch fold, a merge of a batch into a
target and a merge of many micro-batch deltas give the same rows whatever
order the batches come in. One ``groupBy(key)``: one shuffle, with partial
aggregation before it (a replay storm of one key shrinks map-side).
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.functions.normalise import (
    arrival_seq, default_if_absent, stable_uuid, user_email,
)
from ledgerlake.operators.history import history_rows
from ledgerlake.schemas import ARRIVAL_ORDER, EVENT_TARGET, K2, K3, TABLES

ENTITY_TABLES = ["payment_intents", "charges", "refunds", "chargebacks"]
KEYS: dict[str, list[str]] = {
    "payment_intents": K2, "charges": K2, "refunds": K2, "chargebacks": ["chargeback_id"],
    "users": ["user_id"], "merchants": ["merchant_id"], "payment_status_history": K3,
}
# Columns ON CONFLICT overwrites (from the last arrival); the rest stay from the first.
LAST_WINS: dict[str, list[str]] = {t: ["status", "updated_at"] for t in ENTITY_TABLES}
SEQ_COLS = ["first_seq", "last_seq"]
# Columns that are a function of the table key: computed once per folded row.
FROM_KEY = {"payment_status_history": {"event_id": lambda: stable_uuid(*K3)}}


def _route_filter(table: str) -> Column:
    types = [et for et, t in EVENT_TARGET.items() if t == table]
    return F.col("event_type").isin(*types)


def route(events: DataFrame) -> dict[str, DataFrame]:
    """One filtered frame per target table. Cache ``events`` if all four are used."""
    return {t: events.where(_route_filter(t)) for t in ENTITY_TABLES}


def route_counts(events: DataFrame) -> DataFrame:
    """C2 as a report: deliveries per target table (unknown types -> ``rejected``)."""
    m = F.create_map(*[F.lit(x) for kv in EVENT_TARGET.items() for x in kv])
    target = F.coalesce(F.element_at(m, F.col("event_type")), F.lit("rejected"))
    return events.groupBy(target.alias("target_table")).agg(F.count(F.lit(1)).alias("n"))


def _touch(applied_at: datetime | Column | None) -> Column:
    """NOW() of the write: one literal per batch, or each row's ingestion time."""
    if applied_at is None:
        return F.col("ingestion_timestamp")
    if isinstance(applied_at, Column):
        return applied_at
    return F.lit(applied_at).cast("timestamp")


def _non_empty(c: str) -> Column:
    return F.col(c).isNotNull() & (F.col(c) != "")


# Column expressions of each table's candidate row, from one event.
def _entity_columns(table: str, touch: Column, available: T.StructType) -> dict[str, Column]:
    c = F.col
    common = {"status": c("status"), "created_at": touch, "updated_at": touch}
    if table == "payment_intents":
        cols = {n: c(n) for n in ["intent_id", "transaction_id", "idempotency_key", "user_id",
                                  "merchant_id", "amount_minor", "currency", "source_system"]}
    elif table == "charges":
        cols = {n: c(n) for n in ["charge_id", "transaction_id", "idempotency_key", "intent_id",
                                  "amount_minor", "currency", "payment_method", "source_system"]}
    elif table == "refunds":
        cols = {n: c(n) for n in ["refund_id", "transaction_id", "idempotency_key", "charge_id",
                                  "amount_minor", "currency", "refund_reason", "source_system"]}
        # Absent -> false, explicit null stays null; the message's keys are
        # parsed here, for refund rows only.
        payload = available["payload"].dataType if "payload" in available.names else None
        present = (None if payload is None else F.array(*[F.lit(n) for n in payload.names]) if isinstance(payload, T.StructType)
                   else F.json_object_keys(c("payload")))
        cols["is_partial"] = default_if_absent(c("is_partial"), "is_partial", present, False)
    elif table == "chargebacks":
        cols = {n: c(n) for n in ["chargeback_id", "charge_id", "amount_minor", "reason"]}
        cols["filed_at"] = touch
    else:
        raise KeyError(table)
    return {**cols, **common}


def candidates(events: DataFrame, table: str, order: Sequence[str] = ARRIVAL_ORDER,
               applied_at: datetime | Column | None = None, routed: bool = False) -> DataFrame:
    """Each event as a row of ``table`` plus ``first_seq`` / ``last_seq`` (its arrival)."""
    seq = arrival_seq(order)
    touch = _touch(applied_at)
    schema = TABLES[table].schema
    if table in ENTITY_TABLES:
        src = events if routed else events.where(_route_filter(table))
        cols = _entity_columns(table, touch, src.schema)
    elif table == "users":
        src = events.where(_non_empty("user_id"))
        cols = {"user_id": F.col("user_id"), "email": user_email(F.col("user_id")),
                "created_at": touch, "updated_at": touch}
    elif table == "merchants":
        src = events.where(_non_empty("merchant_id"))
        cols = {"merchant_id": F.col("merchant_id"), "merchant_name": F.col("merchant_id"),
                "country": F.lit(None).cast("string"), "created_at": touch, "updated_at": touch}
    elif table == "payment_status_history":
        # the log id replaces the producer's event id, which is part of the order: take the order first
        src = history_rows(events.withColumn("_seq", seq), "entity", with_id=False, keep=["_seq"])
        seq = F.col("_seq")
        cols = {n: F.col(n) for n in schema.fieldNames()}
        cols["event_id"] = F.lit(None).cast("string")
    else:
        raise KeyError(table)
    return src.select(*[cols[f.name].cast(f.dataType).alias(f.name) for f in schema.fields],
                      seq.alias("first_seq"), seq.alias("last_seq"))


def fold_rows(rows: DataFrame, table: str, key: Sequence[str] | None = None) -> DataFrame:
    """Fold candidate or already-folded rows of ``table`` by key (keeps the seq columns)."""
    key = list(key or KEYS[table])
    names = TABLES[table].column_names
    last = LAST_WINS.get(table, [])
    derived = FROM_KEY.get(table, {})
    first = [c for c in names if c not in key and c not in last and c not in derived]
    # the arrival stands first in the row, so the least row is the first one: it travels once
    aggs = [F.min(F.struct("first_seq", *first)).alias("_f")]
    aggs.append(F.max(F.struct("last_seq", *last)).alias("_l"))
    folded = rows.groupBy(*key).agg(*aggs)
    def out_col(c):
        if c in key:
            return F.col(c)
        if c in derived:
            return derived[c]().alias(c)
        return F.col(f"_l.{c}" if c in last else f"_f.{c}").alias(c)
    out = [out_col(c) for c in names]
    return folded.select(*out, F.col("_f.first_seq").alias("first_seq"), F.col("_l.last_seq").alias("last_seq"))


def fold_events(events: DataFrame, table: str, order: Sequence[str] = ARRIVAL_ORDER,
                applied_at: datetime | Column | None = None, routed: bool = False,
                keep_seq: bool = False) -> DataFrame:
    """Fold a batch of events into rows of ``table`` (schema column order)."""
    out = fold_rows(candidates(events, table, order, applied_at, routed), table)
    return out if keep_seq else out.drop(*SEQ_COLS)


def refunds_by_id(events: DataFrame, order: Sequence[str] = ARRIVAL_ORDER,
                  applied_at: datetime | Column | None = None) -> DataFrame:
    """The refunds table keyed by ``refund_id`` instead of the transaction's K2.

    With one idempotency key per transaction, a second refund folds into the
    first refund's row and its id is lost (JN5 lists those deliveries). This
    view keeps one row per refund id, same columns and fold rules.
    """
    out = fold_rows(candidates(events, "refunds", order, applied_at), "refunds", key=["refund_id"])
    return out.drop(*SEQ_COLS)


def merge_into(target: DataFrame, batch: DataFrame, table: str) -> DataFrame:
    """Merge a folded batch into a folded target, both with seq columns (E3-E6 across batches).

    Because both sides carry their arrival bounds, an existing target row
    sorts before every later delivery and a redelivered old batch changes
    nothing: the merge is the same fold.
    """
    return fold_rows(target.unionByName(batch), table)


def derive_users(events: DataFrame, order: Sequence[str] = ARRIVAL_ORDER,
                 applied_at: datetime | Column | None = None) -> DataFrame:
    """E1 + B5 + C13: one user row per non-empty user_id, first write wins."""
    return fold_events(events, "users", order, applied_at)


def derive_merchants(events: DataFrame, order: Sequence[str] = ARRIVAL_ORDER,
                     applied_at: datetime | Column | None = None) -> DataFrame:
    """E2 + B5 + C13: merchant_name = merchant_id, country never set."""
    return fold_events(events, "merchants", order, applied_at)


def insert_if_absent(target: DataFrame, rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """JN6: ON CONFLICT DO NOTHING -- the rows whose key the target lacks (``left_anti``)."""
    return rows.join(target.select(*key), list(key), "left_anti")

