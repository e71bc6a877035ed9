"""Named queries: one Spark builder and (where SQL can say it) one DuckDB oracle each.

Every query reads the driver's tables (the payment log is derived from the
whole ``orders`` table) and returns a lazy DataFrame. Timestamps leave as
UTC wall-clock ``timestamp_ntz`` and every computed column is aliased to the
name the oracle uses.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlake.functions.normalise import payload_field, payload_variant, variant_field
from ledgerlake.operators import dedup, lifecycle, reports, upsert, validate
from ledgerlake.operators.history import history_rows
from ledgerlake.plans import stages
from ledgerlake.plans.oracle import with_events
from ledgerlake.plans.oracle_tables import all_tables_ctes, fold_cte
from ledgerlake.plans.registry import register
from ledgerlake.schemas import TABLES
from ledgerlake.session import work_dir
from ledgerlake.streaming import jobs

SEQ = "ingestion_timestamp, ord, copy_no, event_id"


def _ev(spark, sf_dir):
    return stages.events(spark, sf_dir)


def _dd(spark, sf_dir, columns=("status", "event_timestamp")):
    return dedup.dedup_history(_ev(spark, sf_dir), columns=columns)


# --- flagship: B1, B2 -> D1 -> G1 -> F2 -> H2 ----------------------------------------
@register("h2_top_transitions", with_events("""
SELECT transition, count(*) AS n FROM (
  SELECT coalesce(lag(status) OVER (PARTITION BY transaction_id ORDER BY """ + SEQ + """), 'START')
         || ' -> ' || status AS transition FROM dd)
GROUP BY transition ORDER BY n DESC LIMIT 20""", dedup=True))
def top_transitions(spark, sf_dir):
    """Top 20 life-cycle transitions after deduplication (the reference's summary table)."""
    counts = reports.transition_counts(_dd(spark, sf_dir), collapse=False)
    return reports.top_transitions(counts, 20).select("transition", "n")


# --- B: projections ---------------------------------------------------------------------
@register("b1_amount_minor", with_events(
    "SELECT event_id, copy_no, currency, amount, amount_minor FROM ev"))
def b1_amount_minor(spark, sf_dir):
    return _ev(spark, sf_dir).select("event_id", "copy_no", "currency", "amount", "amount_minor")


@register("b2_timestamps", with_events(
    "SELECT event_id, copy_no, event_timestamp, ingestion_timestamp, "
    "original_transaction_timestamp FROM ev"))
def b2_timestamps(spark, sf_dir):
    return _ev(spark, sf_dir).select("event_id", "copy_no", "event_timestamp",
                                     "ingestion_timestamp", "original_transaction_timestamp")


@register("b4_payload_fields", with_events(
    "SELECT event_id AS log_event_id, payload_event_id, payload_failure_code, payload_amount "
    "FROM t_payment_status_history", dedup=True, extra=all_tables_ctes()))
def b4_payload_fields(spark, sf_dir):
    """B3 + B4: the history payload carries the producer's fields; read three back."""
    h = stages.status_log(stages.raw_events(spark, sf_dir))
    p = F.col("payload")
    return h.select(F.col("event_id").alias("log_event_id"),
                    payload_field(p, "event_id").alias("payload_event_id"),
                    payload_field(p, "failure_code").alias("payload_failure_code"),
                    payload_field(p, "amount").cast("double").alias("payload_amount"))


@register("b4_variant_payload", with_events("""
SELECT event_id AS log_event_id, NOT (event_id LIKE '%1' OR event_id LIKE '%2') AS is_json,
       CASE WHEN NOT regexp_matches(event_id, '[0-3]$') THEN payload_event_id END AS payload_event_id,
       CASE WHEN NOT regexp_matches(event_id, '[0-3]$') THEN payload_failure_code END AS payload_failure_code,
       CASE WHEN NOT regexp_matches(event_id, '[0-3]$') THEN payload_amount END AS payload_amount
FROM t_payment_status_history""", dedup=True, extra=all_tables_ctes()))
def b4_variant_payload(spark, sf_dir):
    """B3 + B4 + C10 on VARIANT: payloads of any kind (a list, a number, two kinds of broken text)
    kept parsed in a written table; fields are read from the parsed value."""
    h = stages.status_log(stages.raw_events(spark, sf_dir))
    last = F.substring("event_id", -1, 1)
    other = F.create_map(*[F.lit(x) for x in ("0", "[1]", "1", "{", "2", '{"event_id": 1} x', "3", "3")])
    payload = F.coalesce(F.try_element_at(other, last), F.col("payload"))
    path = f"{work_dir(spark, 'b4')}/log"
    h.select(F.col("event_id").alias("log_event_id"), payload_variant(payload).alias("payload")).write.parquet(path)
    v = F.col("payload")
    return spark.read.parquet(path).select(
        "log_event_id", v.isNotNull().alias("is_json"), variant_field(v, "event_id").alias("payload_event_id"),
        variant_field(v, "failure_code").alias("payload_failure_code"),
        variant_field(v, "amount", "double").alias("payload_amount"))


@register("b7_log_ids", with_events(
    "SELECT event_id AS log_event_id, transaction_id, event_type FROM t_payment_status_history",
    dedup=True, extra=all_tables_ctes()))
def b7_log_ids(spark, sf_dir):
    """Stable UUID-formatted log ids (SHA-256 of the K3), equal on every redo."""
    h = stages.status_log(stages.raw_events(spark, sf_dir), [])
    return h.select(F.col("event_id").alias("log_event_id"), "transaction_id", "event_type")


# --- D: deduplication -------------------------------------------------------------------
@register("d1_dedup_history", with_events(
    "SELECT transaction_id, idempotency_key, event_type, event_id, copy_no, ingestion_timestamp "
    "FROM dd", dedup=True))
def d1_dedup_history(spark, sf_dir):
    return _dd(spark, sf_dir, ["event_id"]).select(
        "transaction_id", "idempotency_key", "event_type", "event_id", "copy_no",
        "ingestion_timestamp")


@register("d2_dedup_raw", with_events(f"""
SELECT transaction_id, idempotency_key, event_type, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY transaction_id, idempotency_key ORDER BY {SEQ}) rn
  FROM ev) WHERE rn = 1"""))
def d2_dedup_raw(spark, sf_dir):
    return dedup.dedup_raw(_ev(spark, sf_dir), columns=["event_type", "event_id"]).select(
        "transaction_id", "idempotency_key", "event_type", "event_id")


_CLASSIFY_SQL = f"""
cl AS (
  SELECT *, CASE
    WHEN row_number() OVER (PARTITION BY transaction_id, idempotency_key, event_type, event_id
                            ORDER BY {SEQ}) > 1 THEN 'exact_duplicate'
    WHEN retry_attempt > first_value(retry_attempt) OVER (
           PARTITION BY transaction_id, idempotency_key, event_type ORDER BY {SEQ}) THEN 'retry'
    ELSE 'original' END AS delivery_class
  FROM ev)"""


@register("d3_classify_deliveries", with_events(
    "SELECT event_id, copy_no, delivery_class FROM cl", extra=_CLASSIFY_SQL))
def d3_classify(spark, sf_dir):
    return dedup.classify_deliveries(_ev(spark, sf_dir)).select(
        "event_id", "copy_no", "delivery_class")


@register("d4_duplicate_rates", with_events("""
SELECT event_type, count(*) FILTER (delivery_class = 'original') AS originals,
  count(*) FILTER (delivery_class = 'exact_duplicate') AS exact_duplicates,
  count(*) FILTER (delivery_class = 'retry') AS retries,
  count(*) FILTER (delivery_class = 'exact_duplicate') / count(*) FILTER (delivery_class = 'original')
    AS exact_rate,
  count(*) FILTER (delivery_class = 'retry') / count(*) FILTER (delivery_class = 'original')
    AS retry_rate
FROM cl GROUP BY event_type""", extra=_CLASSIFY_SQL))
def d4_duplicate_rates(spark, sf_dir):
    return dedup.duplicate_rates(dedup.classify_deliveries(_ev(spark, sf_dir)), "event_type")


@register("d5_key_collisions", with_events("""
SELECT 'transaction_id' AS id_column,
  count(*) FILTER (transaction_id = idempotency_key OR transaction_id = intent_id
                   OR transaction_id = event_id) AS equal_other,
  count(transaction_id) - count(DISTINCT transaction_id) AS reused,
  count(transaction_id) FILTER (copy_no = 0) - count(DISTINCT transaction_id) FILTER (copy_no = 0)
    AS reused_originals FROM ev
UNION ALL
SELECT 'idempotency_key',
  count(*) FILTER (idempotency_key = transaction_id OR idempotency_key = intent_id
                   OR idempotency_key = event_id),
  count(idempotency_key) - count(DISTINCT idempotency_key),
  count(idempotency_key) FILTER (copy_no = 0) - count(DISTINCT idempotency_key) FILTER (copy_no = 0)
FROM ev
UNION ALL
SELECT 'intent_id',
  count(*) FILTER (intent_id = transaction_id OR intent_id = idempotency_key
                   OR intent_id = event_id),
  count(intent_id) - count(DISTINCT intent_id),
  count(intent_id) FILTER (copy_no = 0) - count(DISTINCT intent_id) FILTER (copy_no = 0)
FROM ev
UNION ALL
SELECT 'event_id',
  count(*) FILTER (event_id = transaction_id OR event_id = idempotency_key OR event_id = intent_id),
  count(event_id) - count(DISTINCT event_id),
  count(event_id) FILTER (copy_no = 0) - count(DISTINCT event_id) FILTER (copy_no = 0)
FROM ev"""))
def d5_key_collisions(spark, sf_dir):
    return dedup.key_collisions(_ev(spark, sf_dir))


# --- F / G / H: counts, windows, top-N --------------------------------------------------
@register("f1_status_counts", with_events(
    "SELECT status, count(*) AS n FROM ev GROUP BY status"))
def f1_status_counts(spark, sf_dir):
    return reports.status_counts(_ev(spark, sf_dir))


@register("f2_transition_counts", with_events(f"""
SELECT transition, count(*) AS n FROM (
  SELECT coalesce(lag(status) OVER (PARTITION BY transaction_id ORDER BY {SEQ}), 'START')
         || ' -> ' || status AS transition FROM ev)
GROUP BY transition"""))
def f2_transition_counts(spark, sf_dir):
    """Transitions over every delivery, copies included (a copy yields ``x -> x``)."""
    return reports.transition_counts(_ev(spark, sf_dir)).select("transition", "n")


@register("g1_previous_status", with_events(f"""
SELECT event_id, copy_no, status,
       lag(status) OVER (PARTITION BY transaction_id ORDER BY {SEQ}) AS prev_status FROM ev"""))
def g1_previous_status(spark, sf_dir):
    ev = _ev(spark, sf_dir).select("transaction_id", "event_id", "status", "ingestion_timestamp",
                                   "ord", "copy_no")
    return reports.with_previous_status(ev).select("event_id", "copy_no", "status", "prev_status")


@register("g2_first_last_status", with_events(f"""
SELECT transaction_id, idempotency_key,
  first(status ORDER BY {SEQ}) AS first_status,
  last(status ORDER BY {SEQ}) AS last_status, count(*) AS deliveries
FROM ev GROUP BY transaction_id, idempotency_key"""))
def g2_first_last(spark, sf_dir):
    return reports.first_and_last(_ev(spark, sf_dir), ["transaction_id", "idempotency_key"])


@register("h1_latest_per_transaction", with_events("""
SELECT transaction_id, event_id AS log_event_id, event_type, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY transaction_id
                               ORDER BY ingestion_timestamp DESC, event_id DESC) AS rank
  FROM t_payment_status_history) WHERE rank <= 10""", dedup=True, extra=all_tables_ctes()))
def h1_latest(spark, sf_dir):
    """H1 for all transactions: the 10 newest log rows of each."""
    h = stages.status_log(stages.raw_events(spark, sf_dir), ["ingestion_timestamp"])
    return reports.latest_per_transaction(h, 10).select(
        "transaction_id", F.col("event_id").alias("log_event_id"), "event_type",
        F.col("rank").cast("long").alias("rank"))


@register("c1_lookup_latest", with_events("""
SELECT event_id AS log_event_id, transaction_id, idempotency_key, event_type, status,
       ingestion_timestamp, payload_event_id
FROM t_payment_status_history WHERE transaction_id = 'txn_7'
ORDER BY ingestion_timestamp DESC, event_id DESC LIMIT 10""", dedup=True, extra=all_tables_ctes()))
def c1_lookup_latest(spark, sf_dir):
    """C1 + H1 + B4: the smoke check's lookup -- one transaction's newest 10 log rows.

    The whole log is written in its lookup layout first; the lookup's filter
    then reaches the parquet scan (PushedFilters) and skips row groups.
    """
    path = jobs.write_status_log(stages.first_raw(stages.raw_events(spark, sf_dir)), f"{work_dir(spark, 'c1')}/log",
                                 make=stages.log_rows)
    h = spark.read.parquet(path)
    return reports.latest_rows(h, "txn_7", 10).select(
        F.col("event_id").alias("log_event_id"), "transaction_id", "idempotency_key",
        "event_type", "status", "ingestion_timestamp",
        payload_field(F.col("payload"), "event_id").alias("payload_event_id"))


@register("f5_rows_per_transaction", with_events(
    "SELECT transaction_id, count(*) AS rows_found FROM t_payment_status_history "
    "GROUP BY transaction_id", dedup=True, extra=all_tables_ctes()))
def f5_rows_per_transaction(spark, sf_dir):
    """F5 for every transaction: log rows a lookup would find."""
    h = stages.status_log(stages.raw_events(spark, sf_dir), [])
    return h.groupBy("transaction_id").agg(F.count(F.lit(1)).alias("rows_found"))


@register("h3_first_n_deliveries", with_events(
    "SELECT transaction_id, event_id, copy_no, status FROM ev "
    "ORDER BY ingestion_timestamp, transaction_id, ord, copy_no LIMIT 1000"))
def h3_first_n(spark, sf_dir):
    """H3: the first 1,000 deliveries in arrival order (the simulation cap, clamped)."""
    return reports.first_n_deliveries(_ev(spark, sf_dir), 1000).select(
        "transaction_id", "event_id", "copy_no", "status")


@register("f4_apply_metrics", with_events(
    "SELECT (SELECT count(*) FROM ev) AS attempted, (SELECT count(*) FROM dd) AS applied, "
    "(SELECT count(*) FROM ev) - (SELECT count(*) FROM dd) AS no_ops", dedup=True))
def f4_apply_metrics(spark, sf_dir):
    """attempted writes beside rows the log actually gained."""
    return reports.apply_metrics(_ev(spark, sf_dir))


# --- J: life cycle -------------------------------------------------------------------
_TYPES_SQL = """
tt AS (
  SELECT transaction_id,
    max(CASE WHEN event_type = 'payment_intent_created' THEN 1 ELSE 0 END) AS created,
    max(CASE WHEN event_type = 'payment_intent_authorized' THEN 1 ELSE 0 END) AS authorized,
    max(CASE WHEN event_type = 'payment_intent_failed' THEN 1 ELSE 0 END) AS failed,
    max(CASE WHEN event_type = 'capture_succeeded' THEN 1 ELSE 0 END) AS captured,
    max(CASE WHEN event_type = 'settlement_recorded' THEN 1 ELSE 0 END) AS settled,
    max(CASE WHEN event_type = 'refund_recorded' THEN 1 ELSE 0 END) AS refunded,
    max(CASE WHEN event_type = 'chargeback_received' THEN 1 ELSE 0 END) AS chargeback
  FROM ev GROUP BY transaction_id)"""


@register("j1_open_authorisations", with_events(
    "SELECT transaction_id FROM tt WHERE authorized = 1 AND captured = 0", extra=_TYPES_SQL))
def j1_open_authorisations(spark, sf_dir):
    return lifecycle.open_authorisations(_ev(spark, sf_dir))


@register("j2_open_captures", with_events(
    "SELECT transaction_id FROM tt WHERE captured = 1 AND settled = 0 AND chargeback = 0",
    extra=_TYPES_SQL))
def j2_open_captures(spark, sf_dir):
    return lifecycle.open_captures(_ev(spark, sf_dir))


@register("f3_pool_sizes", with_events(
    "SELECT count(*) FILTER (authorized = 1 AND captured = 0) AS pending_authorizations, "
    "count(*) FILTER (captured = 1 AND settled = 0 AND chargeback = 0) AS captured_transactions "
    "FROM tt", extra=_TYPES_SQL))
def f3_pool_sizes(spark, sf_dir):
    return lifecycle.pool_sizes(_ev(spark, sf_dir))


@register("j3_lifecycle_state", with_events(f"""
SELECT transaction_id, last(status ORDER BY {SEQ}) AS status,
       max(ingestion_timestamp) AS last_ingestion, count(*) AS deliveries
FROM ev GROUP BY transaction_id"""))
def j3_lifecycle_state(spark, sf_dir):
    return lifecycle.lifecycle_state(_ev(spark, sf_dir))


_EDGES = ("(VALUES ('START','pending'),('pending','authorized'),('pending','failed'),"
          "('authorized','captured'),('captured','settled'),('captured','refunded'),"
          "('captured','chargeback'),('refunded','settled'),('refunded','refunded'),"
          "('refunded','chargeback')) e(p, s)")


def _illegal_sql(order: str) -> str:
    return with_events(f"""
SELECT transaction_id, event_type, prev_status, status FROM (
  SELECT transaction_id, event_type, status,
    coalesce(lag(status) OVER (PARTITION BY transaction_id ORDER BY {order}), 'START') AS prev_status
  FROM dd) g
WHERE NOT EXISTS (SELECT 1 FROM {_EDGES} WHERE e.p = g.prev_status AND e.s = g.status)""",
                       dedup=True)


@register("j4_illegal_transitions", _illegal_sql(SEQ))
def j4_illegal_transitions(spark, sf_dir):
    """J4 in arrival order: the derived log should show none."""
    return lifecycle.illegal_transitions(_dd(spark, sf_dir)).select(
        "transaction_id", "event_type", "prev_status", "status")


@register("j4_illegal_by_event_time", _illegal_sql("event_timestamp, ord, copy_no"))
def j4_illegal_by_event_time(spark, sf_dir):
    """J4 when folded by event time: late events jump ahead of their captures."""
    dd = _dd(spark, sf_dir)
    return lifecycle.illegal_transitions(dd, ["event_timestamp", "ord", "copy_no"]).select(
        "transaction_id", "event_type", "prev_status", "status")


@register("j5_lifecycle_funnel", with_events("""
SELECT step, CAST(transactions AS BIGINT) AS transactions,
       transactions / (SELECT count(*) FROM tt WHERE created = 1) AS share FROM (
  SELECT 'payment_intent_created' AS step, sum(created) AS transactions FROM tt UNION ALL
  SELECT 'payment_intent_authorized', sum(authorized) FROM tt UNION ALL
  SELECT 'payment_intent_failed', sum(failed) FROM tt UNION ALL
  SELECT 'capture_succeeded', sum(captured) FROM tt UNION ALL
  SELECT 'settlement_recorded', sum(settled) FROM tt UNION ALL
  SELECT 'refund_recorded', sum(refunded) FROM tt UNION ALL
  SELECT 'chargeback_received', sum(chargeback) FROM tt)""",
                                               extra=_TYPES_SQL.replace("FROM ev", "FROM dd"),
                                               dedup=True))
def j5_lifecycle_funnel(spark, sf_dir):
    f = lifecycle.lifecycle_funnel(_dd(spark, sf_dir))
    return f.select("step", F.col("transactions").cast("long").alias("transactions"), "share")


@register("j6_failure_breakdown", with_events(
    "SELECT payload_failure_code AS failure_code, count(*) AS n FROM t_payment_status_history "
    "WHERE event_type = 'payment_intent_failed' GROUP BY 1", dedup=True, extra=all_tables_ctes()))
def j6_failure_breakdown(spark, sf_dir):
    return lifecycle.failure_breakdown(stages.status_log(stages.raw_events(spark, sf_dir)))


# --- C: routing and rules ------------------------------------------------------------
@register("c2_route_counts", with_events("""
SELECT CASE WHEN event_type IN ('payment_intent_created','payment_intent_authorized',
                                'payment_intent_failed','settlement_recorded') THEN 'payment_intents'
            WHEN event_type = 'capture_succeeded' THEN 'charges'
            WHEN event_type = 'refund_recorded' THEN 'refunds'
            WHEN event_type = 'chargeback_received' THEN 'chargebacks'
            ELSE 'rejected' END AS target_table, count(*) AS n
FROM ev GROUP BY 1"""))
def c2_route_counts(spark, sf_dir):
    return upsert.route_counts(_ev(spark, sf_dir))


@register("c7_one_entity_literal", with_events("""
SELECT ids_set, count(*) AS n, ids_set = 1 AS passes FROM (
  SELECT (intent_id IS NOT NULL)::INT + (charge_id IS NOT NULL)::INT
         + (refund_id IS NOT NULL)::INT + (chargeback_id IS NOT NULL)::INT AS ids_set FROM ev)
GROUP BY ids_set"""))
def c7_one_entity_literal(spark, sf_dir):
    """C7 on every delivery with all ids kept (the producer's literal rows)."""
    rows = history_rows(_ev(spark, sf_dir), entity_mode="literal")
    return validate.one_entity_summary(rows)


# --- E: entity tables ---------------------------------------------------------------------
def _entity_query(table: str):
    cols = ", ".join(TABLES[table].column_names)

    def fn(spark, sf_dir):
        ev = _ev(spark, sf_dir)
        if table == "users":
            return upsert.derive_users(ev)
        if table == "merchants":
            return upsert.derive_merchants(ev)
        return upsert.fold_events(ev, table)
    fn.__name__ = f"e_{table}"
    return fn, with_events(f"SELECT {cols} FROM t_{table}", dedup=True, extra=all_tables_ctes())


for _code, _table in [("e1", "users"), ("e2", "merchants"), ("e3", "payment_intents"),
                      ("e4", "charges"), ("e5", "refunds"), ("e6", "chargebacks")]:
    _fn, _sql = _entity_query(_table)
    register(f"{_code}_{_table}", _sql)(_fn)


@register("e7_intent_status", with_events(
    "SELECT status, count(*) AS n FROM t_payment_intents GROUP BY status",
    extra=fold_cte("payment_intents").strip("\n")))
def e7_intent_status(spark, sf_dir):
    """Settlement moves the intent, capture does not (captured never appears here)."""
    intents = upsert.fold_events(_ev(spark, sf_dir), "payment_intents")
    return intents.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@register("e5_refunds_by_id", with_events(
    "SELECT " + ", ".join(TABLES["refunds"].column_names) + " FROM t_refunds_by_id",
    extra=fold_cte("refunds", ["refund_id"], "refunds_by_id").strip("\n")))
def e5_refunds_by_id(spark, sf_dir):
    """The refunds view keyed by refund id: a transaction's second refund keeps its own row."""
    return upsert.refunds_by_id(_ev(spark, sf_dir))
