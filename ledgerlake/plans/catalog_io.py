"""Named queries for sources, streams, older shapes, rules and joins.

Streaming queries replay the derived log through a file stream source in
the session's checkpoint folder (``availableNow``), then return a batch
read of what the stream wrote -- the DataFrame the driver sees is the
stream's durable output, never a driver-side collection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.normalise import (
    default_if_absent, normalise_events, parse_iso_timestamp, payload_field, unify_event_versions, unify_v0, unify_v1,
)
from ledgerlake.fixtures import messages as made
from ledgerlake.operators import dedup, lifecycle, reports, upsert, validate
from ledgerlake.plans import stages
from ledgerlake.plans.oracle import with_events
from ledgerlake.plans.oracle_tables import all_tables_ctes, fold_cte
from ledgerlake.plans.registry import register
from ledgerlake.schemas import TABLES, UUID_PATTERN
from ledgerlake.session import work_dir
from ledgerlake.sources import events as src
from ledgerlake.streaming import jobs
from ledgerlake.streaming.keyed import read_metrics
from ledgerlake.streaming.store import FoldedStore, unprocessed

SEQ = "ingestion_timestamp, ord, copy_no, event_id"
# Split point of the derived log for the two-batch queries (A4, JN6, ST6, U1).
CUTOFF = "1998-06-01 00:00:00"
REPLAY_FROM = "1998-05-01 00:00:00"


def _ev(spark, sf_dir):
    return stages.events(spark, sf_dir)


def _before(df: DataFrame, ts: str = CUTOFF) -> DataFrame:
    return df.where(F.col("ingestion_timestamp") < F.lit(ts).cast("timestamp"))


def _from(df: DataFrame, ts: str = CUTOFF) -> DataFrame:
    return df.where(F.col("ingestion_timestamp") >= F.lit(ts).cast("timestamp"))


# --- A1: JSON messages ------------------------------------------------------------------
@register("a1_json_events", with_events(
    "SELECT event_id, copy_no, event_type, amount_minor, ingestion_timestamp, "
    "false AS is_partial FROM ev"))
def a1_json_events(spark, sf_dir):
    """A1 + B6: producer messages parsed back with the explicit schema; ``is_partial``
    is absent from every message, so it takes its default."""
    msgs = made.to_messages(stages.raw_events(spark, sf_dir))
    evs = normalise_events(src.parse_event_messages(msgs))
    return evs.select("event_id", "copy_no", "event_type", "amount_minor", "ingestion_timestamp",
                      default_if_absent(F.col("is_partial"), "is_partial",
                                        src.present_keys(F.col("payload")), False)
                      .alias("is_partial"))


@register("a1_read_files", with_events("""
SELECT event_id, retry_attempt, event_type, amount_minor, ingestion_timestamp,
       CASE WHEN event_type <> 'refund_recorded' THEN false
            WHEN order_key % 3 = 0 THEN true WHEN order_key % 3 = 1 THEN NULL ELSE false END AS is_partial,
       event_id AS payload_event_id FROM ev"""))
def a1_read_files(spark, sf_dir):
    """A1 + B3 + B4 + B6: JSON files through ``read_events``. Refund messages say true, an
    explicit null (it stays null) or nothing (the default)."""
    raw = stages.raw_events(spark, sf_dir)
    text = made.to_messages(raw)
    refund = F.get_json_object("value", "$.event_type") == "refund_recorded"
    said = (F.when(refund & (F.col("order_key") % 3 == 0), ',"is_partial":true}')
            .when(refund & (F.col("order_key") % 3 == 1), ',"is_partial":null}').otherwise("}"))
    path = f"{work_dir(spark, 'a1')}/events"
    text.select(F.concat(F.expr("substring(value, 1, length(value) - 1)"), said).alias("value")) \
        .write.option("compression", "gzip").text(path)
    evs = normalise_events(src.read_events(spark, path))
    return evs.select("event_id", "retry_attempt", "event_type", "amount_minor", "ingestion_timestamp",
                      default_if_absent(F.col("is_partial"), "is_partial",
                                        src.present_keys(F.col("payload")), False).alias("is_partial"),
                      payload_field(F.col("payload"), "event_id").alias("payload_event_id"))


_ISO_FORMS = ["yyyyMMdd'T'HHmmss", "yyyy-MM-dd'T'HH", "yyyy-MM-dd'T'HH:mm:ss',5'", "yyyyMMdd", "yyyy-MM-dd HH:mm",
              "yyyy-MM-dd'T'HHmm'+0200'", "yyyy-MM-dd'T'HH:mm:ss'+02'", "yyyy", "yyyy-MM", "' 'yyyy-MM-dd"]


@register("b2_iso_forms", with_events("""
SELECT event_id, copy_no, CASE order_key % 12
  WHEN 0 THEN ingestion_timestamp WHEN 1 THEN date_trunc('hour', ingestion_timestamp)
  WHEN 2 THEN ingestion_timestamp + INTERVAL 500 MILLISECOND WHEN 3 THEN date_trunc('day', ingestion_timestamp)
  WHEN 4 THEN date_trunc('minute', ingestion_timestamp)
  WHEN 5 THEN date_trunc('minute', ingestion_timestamp) - INTERVAL 2 HOUR
  WHEN 6 THEN ingestion_timestamp - INTERVAL 2 HOUR
  WHEN 10 THEN date_trunc('day', ingestion_timestamp) WHEN 11 THEN date_trunc('week', ingestion_timestamp)
  END AS parsed FROM ev"""))
def b2_iso_forms(spark, sf_dir):
    """B2: basic, hour-only, comma, offset and week forms parse; a year, a month and padded text do not."""
    evs = _ev(spark, sf_dir).select("event_id", "copy_no", "order_key", "ingestion_timestamp")
    ts, k = F.col("ingestion_timestamp"), F.col("order_key") % 12
    text = F.lit(None).cast("string")
    for i, form in enumerate(_ISO_FORMS):
        text = F.when(k == i, F.date_format(ts, form)).otherwise(text)
    week = F.concat(F.extract(F.lit("YEAROFWEEK"), ts).cast("string"), F.lit("-W"),
                    F.lpad(F.weekofyear(ts).cast("string"), 2, "0"))
    day = (F.weekday(ts) + 1).cast("string")
    text = F.when(k == 10, F.concat(week, F.lit("-"), day)).when(
        k == 11, F.replace(week, F.lit("-"), F.lit(""))).otherwise(text)
    return evs.select("event_id", "copy_no", parse_iso_timestamp(text).alias("parsed"))


# --- A2 / ST5 / C11 / ST6: change feed ------------------------------------------------------
_CHANGE_COLS = "event_id, transaction_id, event_type, status, event_timestamp, ingestion_timestamp"


def _change_messages(spark, sf_dir) -> DataFrame:
    """Log rows as change messages, plus a tombstone per chargeback row and the raw
    event topic sharing the stream (both must be filtered out)."""
    history = stages.status_log(stages.raw_events(spark, sf_dir))
    changes = made.to_change_messages(history)
    tombstones = (history.where(F.col("event_type") == "chargeback_received")
                  .select(F.lit(src.CHANGE_TOPIC).alias("topic"),
                          F.lit(None).cast("string").alias("value")))
    other = made.to_messages(stages.raw_events(spark, sf_dir)).select(
        F.lit(src.EVENTS_TOPIC).alias("topic"), "value")
    return changes.unionByName(tombstones).unionByName(other)


@register("a2_change_feed", with_events(
    f"SELECT {_CHANGE_COLS} FROM t_payment_status_history", dedup=True, extra=all_tables_ctes()))
def a2_change_feed(spark, sf_dir):
    """A2 + ST5 + C11: parse the flattened change rows; drop tombstones and other topics."""
    rows = src.read_change_feed(_change_messages(spark, sf_dir))
    return rows.select(*_CHANGE_COLS.split(", "))


@register("st6_snapshot_then_changes", with_events(
    f"SELECT {_CHANGE_COLS} FROM t_payment_status_history", dedup=True, extra=all_tables_ctes()))
def st6_snapshot_then_changes(spark, sf_dir):
    """ST6: snapshot of the log before the cut plus the change feed as a stream from a month
    earlier (replays); the union keeps each log row once."""
    raw = stages.raw_events(spark, sf_dir)
    root = work_dir(spark, "st6")
    made.to_change_messages(stages.status_log(raw, since=REPLAY_FROM)).select("value") \
        .write.option("compression", "gzip").text(f"{root}/in")
    messages = spark.readStream.option("maxFilesPerTrigger", "4").text(f"{root}/in")
    jobs.start_change_stream(messages, f"{root}/out", f"{root}/ckpt").awaitTermination()
    columns = _CHANGE_COLS.split(", ")
    changes = spark.read.parquet(f"{root}/out").select(*columns)
    snapshot = stages.status_log(raw, columns, until=CUTOFF).select(*columns)
    return src.snapshot_then_changes(snapshot, changes)


# --- A3: table scan ----------------------------------------------------------------------
@register("a3_table_scan", with_events(
    "SELECT charge_id, intent_id, status, amount_minor, currency FROM t_charges",
    dedup=True, extra=all_tables_ctes()))
def a3_table_scan(spark, sf_dir):
    """A3: the operational tables written as parquet, scanned back with their declared
    schema (only the projected columns are read)."""
    root = work_dir(spark, "a3")
    upsert.fold_events(_ev(spark, sf_dir), "charges").write.parquet(f"{root}/charges")
    charges = src.read_table(spark, "charges", path=f"{root}/charges")
    return charges.select("charge_id", "intent_id", "status", "amount_minor", "currency")


# --- A4 / A6 / JN6 / U1: batch sinks ----------------------------------------------------------
@register("a4_append_history", with_events(f"""
SELECT event_id AS log_event_id, transaction_id, event_type, status, ingestion_timestamp,
       CASE WHEN ingestion_timestamp < TIMESTAMP '{CUTOFF}' THEN 0 ELSE 1 END AS batch
FROM t_payment_status_history""", dedup=True, extra=all_tables_ctes()))
def a4_append_history(spark, sf_dir):
    """A4: two batches appended to a log and read back whole; the second one (which holds the
    first one's deliveries again) changes no row that was there."""
    evs = stages.materialise_events(stages.events(spark, sf_dir, encode=False).drop("order_key"), f"{work_dir(spark, 'a4')}/events")
    path = f"{work_dir(spark, 'a4')}/log"
    jobs.append_status_history(_before(evs), path, 0)
    again = _before(evs).withColumn("status", F.lit("changed"))
    jobs.append_status_history(_from(evs).unionByName(again), path, 1)
    return spark.read.parquet(path).select(
        F.col("event_id").alias("log_event_id"), "transaction_id", "event_type", "status",
        "ingestion_timestamp", F.col("batch").cast("int").alias("batch"))


@register("a6_unprocessed", with_events("""
SELECT transaction_id, event_type, processed FROM t_raw_payment_events
WHERE NOT (event_id LIKE '%0' OR event_id LIKE '%7')""", dedup=True, extra=all_tables_ctes()))
def a6_unprocessed(spark, sf_dir):
    """Landed rows that are not yet marked as processed (the marks are a set of ids)."""
    raw = stages.landed(stages.raw_events(spark, sf_dir), [])
    done = raw.where(F.col("event_id").endswith("0") | F.col("event_id").endswith("7"))
    return unprocessed(raw, done.select("event_id")).select("transaction_id", "event_type", "processed")


@register("a6_land_raw", with_events("""
SELECT transaction_id, idempotency_key, event_type, ingestion_timestamp, false AS processed,
       payload_event_id FROM (
  SELECT *, event_id AS payload_event_id,
         row_number() OVER (PARTITION BY transaction_id, idempotency_key ORDER BY """ + SEQ + """) rn
  FROM ev) WHERE rn = 1"""))
def a6_land_raw(spark, sf_dir):
    """The raw landing table (UNIQUE on the K2: one row per transaction)."""
    raw = stages.landed(stages.raw_events(spark, sf_dir))
    return raw.select("transaction_id", "idempotency_key", "event_type", "ingestion_timestamp",
                      "processed", F.get_json_object("payload", "$.event_id")
                      .alias("payload_event_id"))


@register("jn6_insert_if_absent", with_events(f"""
SELECT user_id, email FROM t_users WHERE created_at >= TIMESTAMP '{CUTOFF}'""",
                                              dedup=True, extra=all_tables_ctes()))
def jn6_insert_if_absent(spark, sf_dir):
    """JN6: users the second batch inserts; ON CONFLICT DO NOTHING skips known ones."""
    evs = _ev(spark, sf_dir)
    target = upsert.derive_users(_before(evs))
    return upsert.insert_if_absent(target, upsert.derive_users(_from(evs)), ["user_id"]) \
        .select("user_id", "email")


@register("u1_bag_union", with_events("SELECT status, count(*) AS n FROM ev GROUP BY status"))
def u1_bag_union(spark, sf_dir):
    """The two batches appended (duplicates kept) count like the whole log."""
    evs = _ev(spark, sf_dir)
    return reports.status_counts(reports.bag_union(_before(evs), _from(evs)))


# --- B10 / D6 / JN3 / C3-C4: older shapes ------------------------------------------------------
@register("b10_unify_v1", with_events("""
SELECT event_id, copy_no, event_type, status, user_id,
       CASE WHEN ord > 2 THEN event_timestamp END AS ingestion_timestamp
FROM ev"""))
def b10_unify_v1(spark, sf_dir):
    """v1 messages (no event type, int user ids, one timestamp, none on a transaction's
    first two events) in the current shape."""
    raw = stages.raw_events(spark, sf_dir)
    v1 = made.to_v1_messages(raw).withColumn("timestamp", F.when(F.col("ord") > 2, F.col("timestamp")))
    evs = normalise_events(unify_v1(v1))
    return evs.select("event_id", "copy_no", "event_type", "status", "user_id",
                      "ingestion_timestamp")


_V0_TYPE = ("CASE event_type WHEN 'payment_intent_authorized' THEN 'AUTHORIZATION' "
            "WHEN 'capture_succeeded' THEN 'CAPTURE' WHEN 'refund_recorded' THEN 'REFUND' "
            "WHEN 'chargeback_received' THEN 'CHARGEBACK' END")


def _v0(spark, sf_dir) -> DataFrame:
    return made.to_v0_messages(stages.raw_events(spark, sf_dir))


_V0_LATE = "event_type IN ('refund_recorded', 'chargeback_received')"
_V0_COLS = "event_id, copy_no, event_type, status, merchant_id, user_id, amount_minor, ingestion_timestamp"


def _v0_sql(where: str = "") -> str:
    full = ", ".join(f"CASE WHEN NOT {_V0_LATE} THEN {c} END AS {c}" for c in ("merchant_id", "user_id", "amount_minor"))
    return (f"SELECT event_id, copy_no, event_type, status, {full}, ingestion_timestamp FROM ev "
            f"WHERE {_V0_TYPE} IS NOT NULL {where}")


@register("b10_unify_v0", with_events(_v0_sql()))
def b10_unify_v0(spark, sf_dir):
    """v0 messages in the current shape; sparse late rows keep nulls."""
    return normalise_events(unify_v0(_v0(spark, sf_dir))).select(*_V0_COLS.split(", "))


@register("b10_unify_versions", with_events(
    f"{_v0_sql('AND order_key % 3 = 0')} UNION ALL "
    "SELECT event_id, copy_no, event_type, status, merchant_id, user_id, amount_minor, event_timestamp FROM ev "
    "WHERE order_key % 3 = 1 UNION ALL "
    f"SELECT {_V0_COLS} FROM ev WHERE order_key % 3 = 2"))
def b10_unify_versions(spark, sf_dir):
    """A feed of all three message shapes, each transaction in one of them."""
    raw = stages.raw_events(spark, sf_dir)
    third = lambda i: raw.where(F.col("order_key") % 3 == i)
    mixed = unify_event_versions(third(2), made.to_v0_messages(third(0)), made.to_v1_messages(third(1)))
    return normalise_events(mixed).select(*_V0_COLS.split(", "))


@register("d6_v0_exact_copies", with_events(
    f"SELECT {_V0_TYPE} AS event_type, count(DISTINCT event_id) AS n FROM ev "
    f"WHERE {_V0_TYPE} IS NOT NULL GROUP BY 1"))
def d6_v0_exact_copies(spark, sf_dir):
    """v0 messages with the same id twice are one message."""
    once = dedup.drop_exact_copies(_v0(spark, sf_dir), "event_id")
    return once.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@register("c4_reject_reasons", with_events("""
SELECT event_type, 'missing_amount' AS reject_reason, count(*) AS n FROM ev
WHERE event_type IN ('refund_recorded', 'chargeback_received') GROUP BY event_type"""))
def c4_reject_reasons(spark, sf_dir):
    """C3 + C4: unified v0 events checked in quarantine mode; sparse late rows lack an amount."""
    evs = normalise_events(unify_v0(_v0(spark, sf_dir)))
    _, rejects = validate.split_valid(evs, mode="quarantine")
    return rejects.groupBy("event_type", "reject_reason").agg(F.count(F.lit(1)).alias("n"))


_DIRTY = [  # (order_key % 97, column, Spark value, SQL value, reason)
    (1, "transaction_id", None, "NULL", "missing_transaction_id"),
    (2, "idempotency_key", None, "NULL", "missing_idempotency_key"),
    (3, "event_type", None, "NULL", "missing_event_type"),
    (4, "status", None, "NULL", "missing_status"),
    (5, "amount", None, "NULL", "missing_amount"),
    (6, "amount", float("nan"), "'nan'::DOUBLE", "nan_amount"),
    (7, "amount", float("inf"), "'inf'::DOUBLE", "infinite_amount"),
    (8, "amount", 1e20, "1e20", "amount_out_of_range"),
    (9, "currency", None, "NULL", "missing_currency"),
    (10, "event_type", "mystery_event", "'mystery_event'", "unknown_event_type"),
]


def _dirty_raw(spark, sf_dir) -> DataFrame:
    """The raw log with one broken field in some transactions' rows."""
    raw = stages.raw_events(spark, sf_dir)
    kinds = dict(raw.dtypes)
    for column in dict.fromkeys(d[1] for d in _DIRTY):
        value = F.col(column)
        for k, c, v, _, _ in _DIRTY:
            if c == column:
                value = F.when(F.col("order_key") % 97 == k, F.lit(v).cast(kinds[column])).otherwise(value)
        raw = raw.withColumn(column, value)
    return raw


_REASON_SQL = "CASE order_key % 97 " + " ".join(f"WHEN {k} THEN '{r}'" for k, _, _, _, r in _DIRTY) + " END"


@register("c3_c4_dirty_rows", with_events(f"""
SELECT {_REASON_SQL} AS reject_reason, count(*) AS n,
       CAST(sum(amount_minor) FILTER ({_REASON_SQL} IS NULL) AS BIGINT) AS valid_minor FROM ev GROUP BY 1"""))
def c3_c4_dirty_rows(spark, sf_dir):
    """C3 + C4 + B1: every reject reason; no bad amount fails the job, no row is lost."""
    evs = normalise_events(_dirty_raw(spark, sf_dir))
    valid, rejects = validate.split_valid(evs, mode="quarantine")
    both = valid.select(F.lit(None).cast("string").alias("reject_reason"), "amount_minor").unionByName(
        rejects.select("reject_reason", F.lit(None).cast("long").alias("amount_minor")))
    return both.groupBy("reject_reason").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount_minor").alias("valid_minor"))


@register("d3_null_keys", with_events("""
SELECT event_id, copy_no, order_key, ord, CASE
  WHEN row_number() OVER (PARTITION BY transaction_id, idempotency_key, event_type, event_id
                          ORDER BY ingestion_timestamp, ord, copy_no, order_key) > 1 THEN 'exact_duplicate'
  WHEN retry_attempt > first(retry_attempt) OVER (PARTITION BY transaction_id, idempotency_key, event_type
                          ORDER BY ingestion_timestamp, ord, copy_no, event_id NULLS FIRST, order_key) THEN 'retry'
  ELSE 'original' END AS delivery_class FROM ev""",
    changes="CASE WHEN order_key % 97 = 2 THEN NULL ELSE idempotency_key END AS idempotency_key, "
            "CASE WHEN order_key % 97 = 3 THEN NULL ELSE event_id END AS event_id"))
def d3_null_keys(spark, sf_dir):
    """D3 with null idempotency keys and null event ids: every delivery is classified."""
    evs = _ev(spark, sf_dir)
    k = F.col("order_key") % 97
    evs = evs.withColumn("idempotency_key", F.when(k != 2, F.col("idempotency_key"))) \
        .withColumn("event_id", F.when(k != 3, F.col("event_id")))
    return dedup.classify_deliveries(evs).select("event_id", "copy_no", "order_key", "ord", "delivery_class")


@register("jn3_fill_sparse_late", with_events(f"""
SELECT l.event_id, l.copy_no, a.merchant_id, a.amount, a.currency, a.user_id
FROM ev l LEFT JOIN (
  SELECT transaction_id, first(merchant_id ORDER BY {SEQ}) AS merchant_id, first(amount ORDER BY {SEQ}) AS amount,
         first(currency ORDER BY {SEQ}) AS currency, first(user_id ORDER BY {SEQ}) AS user_id
  FROM ev WHERE event_type = 'payment_intent_authorized' GROUP BY transaction_id) a
  ON a.transaction_id = l.transaction_id
WHERE l.event_type IN ('refund_recorded', 'chargeback_received')"""))
def jn3_fill_sparse_late(spark, sf_dir):
    """JN3: v0 late events get merchant, amount, currency and user from the authorisation."""
    raw = stages.raw_events(spark, sf_dir)
    v0 = made.to_v0_messages(raw).where(F.col("metadata_note") == "LATE_ARRIVING_DATA")
    late = normalise_events(unify_v0(v0))
    filled = lifecycle.fill_sparse_late(late, _ev(spark, sf_dir))
    return filled.select("event_id", "copy_no", "merchant_id", "amount", "currency", "user_id")


# --- JN1 / JN2 / JN4 / JN5: links -----------------------------------------------------------
_FIRST_OF = f"""
fa AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY {SEQ}) rn
                      FROM ev WHERE event_type = 'payment_intent_authorized') WHERE rn = 1),
fc AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY {SEQ}) rn
                      FROM ev WHERE event_type = 'capture_succeeded') WHERE rn = 1)"""


@register("jn1_capture_with_authorisation", with_events("""
SELECT c.transaction_id, a.event_id AS auth_event_id, c.event_id AS capture_event_id, c.charge_id,
       a.ingestion_timestamp AS authorized_at, c.ingestion_timestamp AS captured_at,
       date_diff('second', a.ingestion_timestamp, c.ingestion_timestamp) AS seconds_to_capture
FROM fc c JOIN fa a ON a.transaction_id = c.transaction_id
WHERE (c.ingestion_timestamp, c.ord, c.copy_no) > (a.ingestion_timestamp, a.ord, a.copy_no)""",
                                                        extra=_FIRST_OF))
def jn1_capture_with_authorisation(spark, sf_dir):
    return lifecycle.capture_with_authorisation(_ev(spark, sf_dir))


@register("jn2_late_with_capture", with_events(f"""
SELECT l.event_id, l.copy_no, l.event_type, c.capture_charge_id, c.captured_at
FROM ev l LEFT JOIN (
  SELECT transaction_id, first(charge_id ORDER BY {SEQ}) AS capture_charge_id, min(ingestion_timestamp) AS captured_at
  FROM ev WHERE event_type = 'capture_succeeded' GROUP BY transaction_id) c ON c.transaction_id = l.transaction_id
WHERE l.event_type IN ('settlement_recorded', 'refund_recorded', 'chargeback_received')"""))
def jn2_late_with_capture(spark, sf_dir):
    out = lifecycle.late_with_capture(_ev(spark, sf_dir))
    return out.select("event_id", "copy_no", "event_type", "capture_charge_id", "captured_at")


@register("jn4_payment_chain", with_events("""
SELECT i.intent_id, i.transaction_id, i.status AS intent_status, i.currency, c.charge_id,
       c.status AS charge_status, c.amount_minor AS captured_minor,
       coalesce(r.refunds, 0) AS refunds, coalesce(r.refunded_minor, 0) AS refunded_minor,
       coalesce(b.chargebacks, 0) AS chargebacks, coalesce(b.cb_minor, 0) AS charged_back_minor
FROM t_payment_intents i
LEFT JOIN t_charges c ON c.intent_id = i.intent_id
LEFT JOIN (SELECT charge_id, count(*) AS refunds, CAST(sum(amount_minor) AS BIGINT) AS refunded_minor
           FROM t_refunds GROUP BY charge_id) r ON r.charge_id = c.charge_id
LEFT JOIN (SELECT charge_id, count(*) AS chargebacks, CAST(sum(amount_minor) AS BIGINT) AS cb_minor
           FROM t_chargebacks GROUP BY charge_id) b ON b.charge_id = c.charge_id""",
                                           dedup=True, extra=all_tables_ctes()))
def jn4_payment_chain(spark, sf_dir):
    """JN4: intent -> charge -> refunds / chargebacks, children rolled up before joining."""
    evs = stages.materialise_events(_ev(spark, sf_dir), f"{work_dir(spark, 'jn4')}/events")
    tables = {t: upsert.fold_events(evs, t) for t in upsert.ENTITY_TABLES}
    return lifecycle.payment_chain(tables)


@register("jn5_lost_refund_ids", with_events("""
SELECT event_id, copy_no, refund_id FROM ev e
WHERE refund_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM t_refunds r WHERE r.refund_id = e.refund_id)
""", dedup=True, extra=all_tables_ctes()))
def jn5_lost_refund_ids(spark, sf_dir):
    """JN5: deliveries whose refund_id has no refund row -- a second refund of a
    transaction folds into the first (one idempotency key per transaction)."""
    evs = _ev(spark, sf_dir)
    refunds = upsert.fold_events(evs, "refunds")
    return validate.orphan_rows(evs, "refund_id", refunds, "refund_id") \
        .select("event_id", "copy_no", "refund_id")


# --- C12: constraint report ------------------------------------------------------------------
def _report_sql(prefix: str = "t_") -> str:
    parts = []
    order = ["users", "merchants", "payment_intents", "charges", "refunds", "chargebacks",
             "payment_status_history", "raw_payment_events"]
    for name in order:
        t = TABLES[name]
        v = f"{prefix}{name}"
        for c in t.columns:
            if c.not_null or c.name in t.key:
                parts.append(f"SELECT '{name}', 'not_null', '{c.name}', "
                             f"count(*) FILTER ({c.name} IS NULL) FROM {v}")
            if c.max_len is not None:
                parts.append(f"SELECT '{name}', 'max_length', '{c.name}', "
                             f"count(*) FILTER (length({c.name}) > {c.max_len}) FROM {v}")
        if t.one_entity:
            s = " + ".join(f"({c} IS NOT NULL)::INT" for c in t.one_entity)
            parts.append(f"SELECT '{name}', 'one_entity', '{','.join(t.one_entity)}', "
                         f"count(*) FILTER ({s} <> 1) FROM {v}")
        for c in t.uuid_columns:
            parts.append(f"SELECT '{name}', 'uuid_format', '{c}', count(*) FILTER ({c} IS NOT NULL "
                         f"AND NOT regexp_matches({c}, '{UUID_PATTERN}')) FROM {v}")
        for c in t.json_columns:
            parts.append(f"SELECT '{name}', 'json_value', '{c}', count(*) FILTER ({c} IS NOT NULL "
                         f"AND NOT json_valid({c})) FROM {v}")
        for rule, cols in [("primary_key", t.key)] + [("unique", u) for u in t.unique]:
            nn = " AND ".join(f"{c} IS NOT NULL" for c in cols)
            parts.append(f"SELECT '{name}', '{rule}', '{','.join(cols)}', "
                         f"coalesce(sum(n_ - 1), 0) FROM (SELECT count(*) AS n_ FROM {v} "
                         f"WHERE {nn} GROUP BY {', '.join(cols)})")
        for col, ptable, pcol in t.references:
            parts.append(f"SELECT '{name}', 'reference', '{col}->{ptable}.{pcol}', count(*) "
                         f"FROM {v} x WHERE {col} IS NOT NULL AND NOT EXISTS "
                         f"(SELECT 1 FROM {prefix}{ptable} p WHERE p.{pcol} = x.{col})")
    body = "\nUNION ALL\n".join(parts)
    return ("SELECT col0 AS table_name, col1 AS rule, col2 AS columns, "
            "CAST(col3 AS BIGINT) AS violations FROM (" + body.replace(
                "SELECT '", "SELECT '", 1) + ") AS r(col0, col1, col2, col3)")


@register("c12_constraint_report", with_events(_report_sql(), dedup=True, extra=all_tables_ctes()))
def c12_constraint_report(spark, sf_dir):
    """C5-C10 + C12: every declared rule of every table, one row each with its count."""
    return validate.constraint_report(stages.folded_tables(spark, sf_dir, work_dir(spark, "c12")))


# (table, column, column whose md5 decides, md5 prefix, bad value): every kind of rule is broken
_BROKEN = [
    ("users", "email", "user_id", "1", "same@example.com"),
    ("users", "email", "user_id", "2", None),
    ("merchants", "merchant_name", "merchant_id", "1", "m" * 60),
    ("payment_intents", "intent_id", "intent_id", "3a", "intent_dup"),
    ("payment_intents", "currency", "intent_id", "1a", "DOLLARS"),
    ("payment_intents", "status", "intent_id", "2a", None),
    ("payment_intents", "user_id", "intent_id", "4a", "user_none"),
    ("charges", "intent_id", "charge_id", "1a", "intent_none"),
    ("charges", "amount_minor", "charge_id", "2a", None),
    ("refunds", "charge_id", "refund_id", "1", "charge_none"),
    ("refunds", "refund_reason", "refund_id", "2", "r" * 120),
    ("chargebacks", "chargeback_id", "chargeback_id", "1", "chargeback_dup"),
    ("payment_status_history", "refund_id", "event_id", "1a", "refund_none"),
    ("payment_status_history", "payload", "event_id", "2a", "not json"),
    # JSON, if no object: these pass
    ("payment_status_history", "payload", "event_id", "4a", "[1]"),
    ("payment_status_history", "payload", "event_id", "4b", "3"),
    ("payment_status_history", "payload", "event_id", "4c", '"x"'),
    ("payment_status_history", "payload", "event_id", "4d", "null"),
    ("payment_status_history", "payload", "event_id", "4e", '{"a": 1} x'),
    ("payment_status_history", "payload", "event_id", "4f", "1],[2"),
    ("payment_status_history", "event_id", "event_id", "3a", "not-a-uuid"),
    ("raw_payment_events", "payload", "event_id", "1a", "{"),
    ("raw_payment_events", "idempotency_key", "event_id", "2a", None),
    ("raw_payment_events", "event_id", "event_id", "3a", "not-a-uuid"),
]


def _broken_sql() -> str:
    parts = [all_tables_ctes()]
    for t in dict.fromkeys(b[0] for b in _BROKEN):
        cases: dict[str, str] = {}
        for _, column, by, prefix, bad in [b for b in _BROKEN if b[0] == t]:
            value = "NULL" if bad is None else f"'{bad}'"
            cases[column] = cases.get(column, "") + f" WHEN md5({by}) LIKE '{prefix}%' THEN {value}"
        replaced = ", ".join(f"CASE{c} ELSE {column} END AS {column}" for column, c in cases.items())
        parts.append(f"x_{t} AS (SELECT * REPLACE ({replaced}) FROM t_{t})")
    return ",\n".join(parts)


def _broken(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    out = {}
    for name, df in tables.items():
        new = {}
        for t, column, by, prefix, bad in reversed(_BROKEN):
            if t == name:
                kind = dict(df.dtypes)[column]
                new[column] = F.when(F.md5(F.col(by)).startswith(prefix), F.lit(bad).cast(kind)).otherwise(
                    new.get(column, F.col(column)))
        out[name] = df.withColumns(new) if new else df
    return out


@register("c12_broken_tables", with_events(_report_sql("x_"), dedup=True, extra=_broken_sql()))
def c12_broken_tables(spark, sf_dir):
    """C5-C10 + C12 on tables in which every kind of rule is broken."""
    return validate.constraint_report(_broken(stages.folded_tables(spark, sf_dir, work_dir(spark, "c12x"))))


@register("c12_batched_report", with_events(_report_sql("x_"), dedup=True, extra=_broken_sql()))
def c12_batched_report(spark, sf_dir):
    """C5-C10 + C12 kept up over three batches of rows of all tables in random order: children come
    before their parents, keys repeat across batches."""
    root = work_dir(spark, "c12b")
    # the tables are written dealt over the batches, so that a batch reads its own rows only
    deal = lambda tables: {name: df.withColumn("_part", F.pmod(F.xxhash64(*TABLES[name].column_names), F.lit(3)).cast("int"))
                           for name, df in _broken(tables).items()}
    tables = stages.materialise_tables(spark, sf_dir, root, change=deal, by=["_part"])
    for i in range(3):
        part = {name: df.where(F.col("_part") == i).drop("_part") for name, df in tables.items()}
        jobs.apply_rule_facts(part, f"{root}/report", i)
    return jobs.read_constraint_report(spark, f"{root}/report", {name: TABLES[name].column_names for name in tables})


@register("c1_events_of_a_month", with_events("""
SELECT event_type, count(*) AS n, min(event_timestamp) AS first_event FROM t_payment_status_history
WHERE event_timestamp >= TIMESTAMP '1996-03-01' AND event_timestamp < TIMESTAMP '1996-04-01'
GROUP BY event_type""", dedup=True, extra=all_tables_ctes()))
def c1_events_of_a_month(spark, sf_dir):
    """A read by event time from the log's event-time layout (one folder is opened)."""
    path = jobs.write_status_log(stages.first_raw(stages.raw_events(spark, sf_dir)), f"{work_dir(spark, 'c1t')}/log",
                                 make=stages.log_rows, by="event_time")
    rows = spark.read.parquet(path).where(
        (F.col("event_month") == "1996-03") & (F.col("event_timestamp") >= F.lit("1996-03-01").cast("timestamp"))
        & (F.col("event_timestamp") < F.lit("1996-04-01").cast("timestamp")))
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.min("event_timestamp").alias("first_event"))


# --- ST1 / ST2: lateness ------------------------------------------------------------------------
_LAG = "date_diff('second', event_timestamp, ingestion_timestamp)"


@register("st1_lateness_bands", with_events(f"""
SELECT lateness_band, count(*) AS n, min(lag_seconds) AS min_lag_seconds,
       max(lag_seconds) AS max_lag_seconds FROM (
  SELECT {_LAG} AS lag_seconds,
    CASE WHEN {_LAG} IS NULL THEN 'unknown' WHEN {_LAG} <= 0 THEN 'on_time'
         WHEN {_LAG} <= 5 THEN 'seconds' WHEN {_LAG} < 86400 THEN 'minutes_to_hours'
         ELSE 'days' END AS lateness_band FROM ev)
GROUP BY lateness_band"""))
def st1_lateness_bands(spark, sf_dir):
    return lifecycle.lateness_bands(_ev(spark, sf_dir))


@register("st2_late_split", with_events(f"""
SELECT CASE WHEN {_LAG} > 86400 THEN 'late' ELSE 'on_time' END AS output, event_type,
       count(*) AS n FROM ev GROUP BY 1, 2"""))
def st2_late_split(spark, sf_dir):
    """ST2: events more than a day late by event time go to their own output, none dropped."""
    on_time, late = lifecycle.split_late(_ev(spark, sf_dir), 86400)
    tagged = on_time.withColumn("output", F.lit("on_time")).unionByName(
        late.withColumn("output", F.lit("late")))
    return tagged.groupBy("output", "event_type").agg(F.count(F.lit(1)).alias("n"))


# --- ST2 / ST3 / ST4 / ST7: streams over message files -----------------------------------------------
# Which micro-batch a delivery comes with: by year, but a sixteenth of all deliveries come days
# or years late with the last batch, and some have no readable ingestion time.
_NO_TIME = "CASE WHEN md5(event_id || copy_no) LIKE '0a%' THEN NULL ELSE ingestion_timestamp END AS ingestion_timestamp"
_CHUNK = ("CASE WHEN md5(event_id || copy_no) LIKE 'a%' THEN 3 WHEN ingestion_timestamp IS NULL THEN 0 "
          "WHEN year(ingestion_timestamp) < 1997 THEN 0 WHEN year(ingestion_timestamp) < 1999 THEN 1 ELSE 2 END")
_SEQ0 = "ingestion_timestamp NULLS FIRST, ord, copy_no, event_id"


def _stream_input(spark, sf_dir, name: str):
    root = work_dir(spark, name)
    digest = F.md5(F.concat("event_id", F.col("copy_no").cast("string")))
    raw = stages.raw_events(spark, sf_dir).withColumn(
        "ingestion_timestamp", F.when(~digest.startswith("0a"), F.col("ingestion_timestamp")))
    year = F.substring("ingestion_timestamp", 1, 4).cast("int")
    chunk = (F.when(digest.startswith("a"), 3).when(year.isNull(), 0).when(year < 1997, 0)
             .when(year < 1999, 1).otherwise(2))
    files = max(8, stages.log_tasks(spark, sf_dir))
    made.write_message_files(raw, f"{root}/in", chunk, 4, files)
    return root, jobs.message_stream(spark, f"{root}/in", files)


@register("st3_stream_dedup", with_events(f"""
SELECT transaction_id, idempotency_key, event_type, status, chunk FROM (
  SELECT *, row_number() OVER (PARTITION BY transaction_id, idempotency_key, event_type
                               ORDER BY chunk, {_SEQ0}) AS rn FROM (SELECT *, {_CHUNK} AS chunk FROM ev))
WHERE rn = 1""", changes=_NO_TIME))
def st3_stream_dedup(spark, sf_dir):
    """ST3: first delivery per K3 over all batches; late and undated deliveries count."""
    root, stream = _stream_input(spark, sf_dir, "st3")
    jobs.start_dedup_stream(stream, f"{root}/out", f"{root}/ckpt").awaitTermination()
    return spark.read.parquet(f"{root}/out").select(
        "transaction_id", "idempotency_key", "event_type", "status", F.col("batch").cast("int").alias("chunk"))


def _batched(sql: str) -> str:
    """The fold's arrival order with the batch in front; null is the earliest time."""
    return (sql.replace("ORDER BY ingestion_timestamp, ord", "ORDER BY chunk, ingestion_timestamp NULLS FIRST, ord")
            .replace("ORDER BY ingestion_timestamp DESC", "ORDER BY chunk DESC, ingestion_timestamp DESC"))


@register("st4_stream_upsert", with_events(
    "SELECT " + ", ".join(TABLES["payment_intents"].column_names) + " FROM t_payment_intents",
    extra=_batched(fold_cte("payment_intents").strip("\n").replace("FROM ev WHERE", f"FROM (SELECT *, {_CHUNK} AS chunk FROM ev) WHERE")),
    changes=_NO_TIME))
def st4_stream_upsert(spark, sf_dir):
    """ST4 + A5: micro-batches folded into all tables. A row of an earlier batch comes before
    every row of a later one, so a late older delivery updates the status and nothing else."""
    root, stream = _stream_input(spark, sf_dir, "st4")
    store = FoldedStore(spark, f"{root}/store")
    jobs.start_upsert_stream(stream, store, f"{root}/ckpt").awaitTermination()
    return store.read("payment_intents")


@register("a5_older_second_batch", with_events(
    "SELECT intent_id, status, amount_minor FROM t_payment_intents",
    extra=fold_cte("payment_intents").strip("\n").replace(
        "FROM ev WHERE", f"FROM (SELECT *, CASE WHEN ingestion_timestamp >= TIMESTAMP '{CUTOFF}' THEN 0 ELSE 1 END AS chunk "
        "FROM ev) WHERE").replace("ORDER BY ingestion_timestamp,", "ORDER BY chunk, ingestion_timestamp,").replace(
        "ORDER BY ingestion_timestamp DESC", "ORDER BY chunk DESC, ingestion_timestamp DESC"),
    changes="CASE WHEN ord = 2 THEN ingestion_timestamp - INTERVAL 20 YEAR ELSE ingestion_timestamp END AS ingestion_timestamp, "
            "CASE WHEN ord = 2 THEN amount_minor + 1 ELSE amount_minor END AS amount_minor"))
def a5_older_second_batch(spark, sf_dir):
    """A5: a second batch with older ingestion times: existing rows keep their first columns,
    the second batch's last status wins."""
    old = F.col("ord") == 2
    evs = _ev(spark, sf_dir)
    evs = evs.withColumn("ingestion_timestamp", F.when(old, F.col("ingestion_timestamp") - F.make_ym_interval(F.lit(20)))
                         .otherwise(F.col("ingestion_timestamp"))) \
        .withColumn("amount_minor", F.col("amount_minor") + old.cast("int"))
    store = FoldedStore(spark, f"{work_dir(spark, 'a5')}/store", ["payment_intents"])
    store.apply_events(_before(evs), 1)
    store.apply_events(_from(evs), 0)
    store.apply_events(_before(evs), 1)   # a redo changes nothing
    return store.read("payment_intents").select("intent_id", "status", "amount_minor")


@register("st7_stream_lifecycle", with_events(f"""
SELECT transaction_id, last(status ORDER BY {_SEQ0}) AS status, count(*) AS deliveries
FROM ev GROUP BY transaction_id""", changes=_NO_TIME))
def st7_stream_lifecycle(spark, sf_dir):
    """ST7: last status per transaction from a stream; late and undated deliveries count."""
    root, stream = _stream_input(spark, sf_dir, "st7")
    jobs.start_lifecycle_stream(stream, f"{root}/out", f"{root}/ckpt").awaitTermination()
    return jobs.read_lifecycle(spark, f"{root}/out")


_WAIT_HOURS = 1


@register("jn1_stream_join", with_events(f"""
SELECT 'matched' AS output, transaction_id, auth_event_id, capture_event_id, NULL::INTEGER AS copy_no, charge_id,
       date_diff('second', authorized_at, captured_at) AS seconds_to_capture
FROM (
  SELECT transaction_id, first(a_event ORDER BY a_time, a_ord, a_copy, a_event) AS auth_event_id,
         first(a_time ORDER BY a_time, a_ord, a_copy, a_event) AS authorized_at,
         min((a_time, a_ord, a_copy, a_event)) AS a_seq,
         first(c_event ORDER BY c_time, c_ord, c_copy, c_event) AS capture_event_id,
         first(charge_id ORDER BY c_time, c_ord, c_copy, c_event) AS charge_id,
         first(c_time ORDER BY c_time, c_ord, c_copy, c_event) AS captured_at,
         min((c_time, c_ord, c_copy, c_event)) AS c_seq
  FROM pairs GROUP BY transaction_id) WHERE c_seq > a_seq
UNION ALL
SELECT 'unmatched', transaction_id, NULL, event_id, copy_no, NULL, NULL FROM caps c
WHERE NOT EXISTS (SELECT 1 FROM pairs p WHERE p.c_event = c.event_id AND p.c_copy = c.copy_no)""", extra=f"""
arr AS (SELECT *, {_CHUNK} AS chunk FROM ev WHERE order_key % 19 <> 0 OR event_type <> 'payment_intent_authorized'),
auths AS (SELECT * FROM arr WHERE event_type = 'payment_intent_authorized'),
caps AS (SELECT * FROM arr WHERE event_type = 'capture_succeeded'),
pairs AS (
  SELECT c.transaction_id, a.event_id AS a_event, a.ingestion_timestamp AS a_time, a.ord AS a_ord, a.copy_no AS a_copy,
         c.event_id AS c_event, c.ingestion_timestamp AS c_time, c.ord AS c_ord, c.copy_no AS c_copy, c.charge_id
  FROM caps c JOIN auths a ON a.transaction_id = c.transaction_id AND abs(a.chunk - c.chunk) <= {_WAIT_HOURS})"""))
def jn1_stream_join(spark, sf_dir):
    """JN1 over two streams of out-of-order files: pairs that arrive within the wait are joined, captures
    without an authorisation (or with one that comes too late) reach an output of their own."""
    root = work_dir(spark, "jn1s")
    evs = _ev(spark, sf_dir).where((F.col("order_key") % 19 != 0) | (F.col("event_type") != "payment_intent_authorized"))
    auths, captures = arriving_files(evs.withColumn("chunk", _chunk_column()), root, 4)
    jobs.start_capture_join_stream(auths, captures, f"{root}/out", f"{root}/ckpt", f"{_WAIT_HOURS} HOURS").awaitTermination()
    links, left = jobs.read_capture_links(spark, f"{root}/out")
    none = lambda kind: F.lit(None).cast(kind)
    return links.select(F.lit("matched").alias("output"), "transaction_id", "auth_event_id", "capture_event_id",
                        none("int").alias("copy_no"), "charge_id", "seconds_to_capture").unionByName(
        left.select(F.lit("unmatched").alias("output"), "transaction_id", none("string").alias("auth_event_id"),
                    "capture_event_id", "copy_no", none("string").alias("charge_id"), none("long").alias("seconds_to_capture")))


@register("st7_open_too_long", with_events(f"""
SELECT a.transaction_id, a.event_id, a.copy_no, TIMESTAMP '2000-01-01' + to_hours(a.chunk) AS arrived_at,
       a.transaction_id IN (SELECT transaction_id FROM caps) AS closed_late
FROM auths a WHERE NOT EXISTS (
  SELECT 1 FROM caps c WHERE c.transaction_id = a.transaction_id AND abs(a.chunk - c.chunk) <= {_WAIT_HOURS})""", extra=f"""
arr AS (SELECT *, {_CHUNK} AS chunk FROM ev),
auths AS (SELECT * FROM arr WHERE event_type = 'payment_intent_authorized'),
caps AS (SELECT * FROM arr WHERE event_type = 'capture_succeeded')"""))
def st7_open_too_long(spark, sf_dir):
    """ST7 with timers: authorisations that waited an hour in vain, and whether a later capture closed them."""
    root = work_dir(spark, "st7o")
    auths, captures = arriving_files(_ev(spark, sf_dir).withColumn("chunk", _chunk_column()), root, 4)
    for query in jobs.start_open_stream(auths, captures, f"{root}/out", f"{root}/ckpt", f"{_WAIT_HOURS} HOURS"):
        query.awaitTermination()
    return jobs.read_open(spark, f"{root}/out")


def _chunk_column() -> Column:
    """The chunk that a normalised delivery comes with (as ``_CHUNK``)."""
    digest, year = F.md5(F.concat("event_id", F.col("copy_no").cast("string"))), F.year("ingestion_timestamp")
    return F.when(digest.startswith("a"), 3).when(year < 1997, 0).when(year < 1999, 1).otherwise(2)


def arriving_files(events: DataFrame, root: str, n_chunks: int) -> tuple[DataFrame, DataFrame]:
    """Authorisations and captures as two streams of files, a chunk an hour, and a heartbeat behind the last."""
    spark = events.sparkSession
    columns = ["transaction_id", "event_id", "charge_id", "ingestion_timestamp", "ord", "copy_no"]
    hour = lambda i: F.lit("2000-01-01").cast("timestamp") + F.make_dt_interval(hours=F.lit(i))
    staged = stages.materialise_events(events.select(*columns, "event_type", "chunk"), f"{root}/staged")
    streams = []
    for event_type in ("payment_intent_authorized", "capture_succeeded"):
        path = f"{root}/{event_type}"
        for i in range(n_chunks):
            rows = staged.where((F.col("event_type") == event_type) & (F.col("chunk") == i))
            rows.select(*columns, hour(i).alias("arrived_at")).repartition(2).write.mode("append").parquet(path)
        beat = spark.range(2).select(*[F.lit(jobs.HEARTBEAT if c == "transaction_id" else None).cast(dict(staged.dtypes)[c])
                                       .alias(c) for c in columns], hour(1000).alias("arrived_at")).repartition(2)
        beat.write.mode("append").parquet(path)
        schema = spark.read.parquet(path).schema
        streams.append(spark.readStream.schema(schema).option("maxFilesPerTrigger", "2").parquet(path))
    return streams[0], streams[1]


@register("st5_keyed_deletes", with_events(
    f"SELECT {_CHANGE_COLS} FROM t_payment_status_history "
    "WHERE event_type <> 'chargeback_received' OR event_id LIKE '%0'", dedup=True, extra=all_tables_ctes()))
def st5_keyed_deletes(spark, sf_dir):
    """ST5: tombstones as deletes: the log without its chargebacks, but for those written again afterwards."""
    history = stages.status_log(stages.raw_events(spark, sf_dir))
    rows = made.to_change_messages(history).withColumn("key", F.get_json_object("value", "$.event_id"))
    gone = rows.where(F.get_json_object("value", "$.event_type") == "chargeback_received")
    feed = rows.select("key", "value", F.lit(1).alias("offset")).unionByName(
        gone.select("key", F.lit(None).cast("string").alias("value"), F.lit(2).alias("offset"))).unionByName(
        gone.where(F.col("key").endswith("0")).select("key", "value", F.lit(3).alias("offset")))
    return src.read_change_feed(src.latest_changes(feed)).select(*_CHANGE_COLS.split(", "))


@register("c1_lookup_by_entity", with_events("""
SELECT 'charge_8' AS asked, transaction_id, event_type, status FROM t_payment_status_history WHERE charge_id = 'charge_8'
UNION ALL SELECT 'intent_8', transaction_id, event_type, status FROM t_payment_status_history WHERE intent_id = 'intent_8'
UNION ALL SELECT 'txn_8', transaction_id, event_type, status FROM t_payment_status_history WHERE transaction_id = 'txn_8'
""", dedup=True, extra=all_tables_ctes()))
def c1_lookup_by_entity(spark, sf_dir):
    """Rows by charge, intent and transaction from the log with Parquet Bloom filters on its ids."""
    path = jobs.write_status_log(stages.first_raw(stages.raw_events(spark, sf_dir)), f"{work_dir(spark, 'c1b')}/log",
                                 make=stages.log_rows, by="ids")
    log = spark.read.parquet(path)
    asked = [("charge_id", "charge_8"), ("intent_id", "intent_8"), ("transaction_id", "txn_8")]
    return reports.bag_union(*[log.where(F.col(c) == v).select(
        F.lit(v).alias("asked"), "transaction_id", "event_type", "status") for c, v in asked])


@register("d5_sketched_reuse", with_events("""
SELECT id_column, n, true AS within_error FROM (
  SELECT 'transaction_id' AS id_column, count(transaction_id) AS n FROM ev UNION ALL
  SELECT 'idempotency_key', count(idempotency_key) FROM ev UNION ALL
  SELECT 'intent_id', count(intent_id) FROM ev UNION ALL SELECT 'event_id', count(event_id) FROM ev)"""))
def d5_sketched_reuse(spark, sf_dir):
    """D5's first look: sketches of two batches merged, within their stated error of the exact counts."""
    evs = _ev(spark, sf_dir)
    sketches = dedup.id_sketches(_before(evs)).unionAll(dedup.id_sketches(_from(evs)))
    exact = dedup.key_collisions(evs).select("id_column", "reused")
    look = dedup.sketched_reuse(sketches).join(exact, "id_column")
    distinct = F.col("n") - F.col("reused")
    return look.select("id_column", "n", (F.abs(F.col("distinct_estimate") - distinct)
                                          <= dedup.SKETCH_ERROR * distinct).alias("within_error"))


@register("f2_stream_transitions", with_events(f"""
SELECT transition, count(*) AS n FROM (
  SELECT coalesce(lag(status) OVER (PARTITION BY transaction_id ORDER BY {_SEQ0}), 'START')
         || ' -> ' || status AS transition FROM ev) GROUP BY transition""", changes=_NO_TIME))
def f2_stream_transitions(spark, sf_dir):
    """F2 + G1 kept up over a stream: late deliveries fall between earlier ones and replace transitions."""
    root, stream = _stream_input(spark, sf_dir, "f2")
    jobs.start_transition_stream(stream, f"{root}/out", f"{root}/ckpt").awaitTermination()
    return jobs.read_transitions(spark, f"{root}/out")


@register("f4_stream_metrics", with_events("""
SELECT count(*) AS attempted, count(DISTINCT (transaction_id, idempotency_key, event_type)) AS applied,
       count(*) - count(DISTINCT (transaction_id, idempotency_key, event_type)) AS no_ops FROM ev"""))
def f4_stream_metrics(spark, sf_dir):
    """attempted and applied counts observed by the writes of a stream, with no job of their own."""
    root, stream = _stream_input(spark, sf_dir, "f4")
    jobs.start_dedup_stream(stream, f"{root}/out", f"{root}/ckpt").awaitTermination()
    return read_metrics(spark, f"{root}/out")


@register("st2_stream_late_split", with_events(f"""
SELECT CASE WHEN {_LAG} > 86400 THEN 'late' ELSE 'on_time' END AS output, event_type,
       count(*) AS n FROM ev GROUP BY 1, 2""", changes=_NO_TIME))
def st2_stream_late_split(spark, sf_dir):
    """ST2 in a stream: late rows go to their own output, none lost."""
    root, stream = _stream_input(spark, sf_dir, "st2")
    jobs.start_late_split_stream(stream, f"{root}/out", f"{root}/ckpt", 86400).awaitTermination()
    rows = spark.read.parquet(f"{root}/out")
    return (rows.withColumnRenamed("_table", "output")
            .groupBy("output", "event_type").agg(F.count(F.lit(1)).alias("n")))


# --- ties: two events of one instant and step ---------------------------------------------------
_TIED = ("CASE WHEN ord >= 4 THEN original_transaction_timestamp + INTERVAL 3 HOUR ELSE ingestion_timestamp END "
         "AS ingestion_timestamp, CAST(least(ord, 4) AS INTEGER) AS ord, CAST(0 AS INTEGER) AS copy_no")


def _tied(spark, sf_dir) -> DataFrame:
    """Settlements, refunds and chargebacks of a transaction at one instant, as a feed without
    step and copy numbers would give them."""
    evs = _ev(spark, sf_dir)
    late = F.col("ord") >= 4
    return evs.withColumn("ingestion_timestamp", F.when(late, F.col("original_transaction_timestamp")
                                                        + F.make_dt_interval(hours=F.lit(3)))
                          .otherwise(F.col("ingestion_timestamp"))) \
        .withColumn("ord", F.least(F.col("ord"), F.lit(4))).withColumn("copy_no", F.lit(0))


@register("j3_tied_events", with_events(f"""
SELECT transaction_id, last(status ORDER BY {SEQ}) AS status, max(ingestion_timestamp) AS last_ingestion,
       count(*) AS deliveries FROM ev GROUP BY transaction_id""", changes=_TIED))
def j3_tied_events(spark, sf_dir):
    """J3 with a refund and a chargeback at one instant: the event id decides, on any row order."""
    return lifecycle.lifecycle_state(_tied(spark, sf_dir))


@register("f2_tied_events", with_events(f"""
SELECT transition, count(*) AS n FROM (
  SELECT coalesce(lag(status) OVER (PARTITION BY transaction_id ORDER BY {SEQ}), 'START')
         || ' -> ' || status AS transition FROM ev) GROUP BY transition""", changes=_TIED))
def f2_tied_events(spark, sf_dir):
    """F2 / G1 with ties in time, step and copy."""
    return reports.transition_counts(_tied(spark, sf_dir)).select("transition", "n")
