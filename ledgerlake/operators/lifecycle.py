"""Life cycle questions and links between events (J1-J6, JN1-JN6, ST1-ST2).

The producer keeps "pending" and "captured" stores in memory; here they are
queries over the log. Every operator is an aggregation keyed by
``transaction_id`` (partial + final, so hot keys pre-aggregate) or an
equi-join on it; the allowed-transition edge table is a fixed 10-row
literal, broadcast by construction.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.normalise import arrival_seq, payload_field
from ledgerlake.operators.reports import START, with_previous_status
from ledgerlake.schemas import ALLOWED_TRANSITIONS, ARRIVAL_ORDER, EVENT_STATUS

_CLOSING_CAPTURE = ["settlement_recorded", "chargeback_received"]


def _types_per_txn(events: DataFrame) -> DataFrame:
    """One row per transaction with a flag per event type (one partial aggregate)."""
    return events.groupBy("transaction_id").agg(*[
        F.max((F.col("event_type") == et).cast("int")).alias(et) for et in EVENT_STATUS])


def open_authorisations(events: DataFrame) -> DataFrame:
    """Transactions authorised and not captured (the producer's pending store)."""
    t = _types_per_txn(events)
    return t.where((F.col("payment_intent_authorized") == 1) & (F.col("capture_succeeded") == 0)) \
        .select("transaction_id")


def open_captures(events: DataFrame) -> DataFrame:
    """Captured, neither settled nor charged back; a refund keeps it open."""
    t = _types_per_txn(events)
    closed = F.greatest(*[F.col(c) for c in _CLOSING_CAPTURE])
    return t.where((F.col("capture_succeeded") == 1) & (closed == 0)).select("transaction_id")


def pool_sizes(events: DataFrame) -> DataFrame:
    """sizes of both stores in one pass."""
    t = _types_per_txn(events)
    closed = F.greatest(*[F.col(c) for c in _CLOSING_CAPTURE])
    return t.agg(
        F.count_if((F.col("payment_intent_authorized") == 1) & (F.col("capture_succeeded") == 0))
        .alias("pending_authorizations"),
        F.count_if((F.col("capture_succeeded") == 1) & (closed == 0)).alias("captured_transactions"),
    )


def lifecycle_state(events: DataFrame, order: Sequence[str] = ARRIVAL_ORDER) -> DataFrame:
    """Last status per transaction by arrival (``max_by``, not event time)."""
    seq = arrival_seq(order)
    return events.groupBy("transaction_id").agg(
        F.max_by(F.col("status"), seq).alias("status"),
        F.max(F.col("ingestion_timestamp")).alias("last_ingestion"),
        F.count(F.lit(1)).alias("deliveries"))


def allowed_transitions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ALLOWED_TRANSITIONS, "prev_status string, status string")


def illegal_transitions(deduped: DataFrame, order: Sequence[str] = ARRIVAL_ORDER) -> DataFrame:
    """Transitions outside the allowed graph, on the deduplicated log.

    A copy's ``x -> x`` never reaches here because D1 ran first. The edge
    table has 10 rows: broadcasting it is safe at any data size.
    """
    spark = deduped.sparkSession
    g = with_previous_status(deduped, order).withColumn(
        "prev_status", F.coalesce(F.col("prev_status"), F.lit(START)))
    edges = F.broadcast(allowed_transitions(spark))
    return g.join(edges, ["prev_status", "status"], "left_anti")


def lifecycle_funnel(deduped: DataFrame) -> DataFrame:
    """Transactions reaching each step and their share of all created."""
    t = _types_per_txn(deduped)
    steps = ["payment_intent_created", "payment_intent_authorized", "payment_intent_failed",
             "capture_succeeded", "settlement_recorded", "refund_recorded", "chargeback_received"]
    agg = t.agg(*[F.sum(F.col(s)).cast("long").alias(s) for s in steps])
    stack = ", ".join(f"'{s}', `{s}`" for s in steps)
    long = agg.selectExpr("payment_intent_created as _base",
                          f"stack({len(steps)}, {stack}) as (step, transactions)")
    return long.select("step", "transactions",
                       (F.col("transactions") / F.col("_base")).alias("share"))


def failure_breakdown(history: DataFrame) -> DataFrame:
    """Failures per failure code, read from the JSON payload."""
    code = payload_field(F.col("payload"), "failure_code")
    return (history.where(F.col("event_type") == "payment_intent_failed")
            .groupBy(code.alias("failure_code")).agg(F.count(F.lit(1)).alias("n")))


# --- JN1-JN3: links between events ---------------------------------------------
def capture_with_authorisation(events: DataFrame, order: Sequence[str] = ARRIVAL_ORDER
                               ) -> DataFrame:
    """JN1: each capture joined to the authorisation it follows (equi-join on transaction).

    Both sides are first reduced to one row per transaction (first arrival),
    so the join never fans out, even for a hot transaction.
    """
    seq = arrival_seq(order)

    def firsts(event_type, cols):
        return (events.where(F.col("event_type") == event_type)
                .groupBy("transaction_id")
                .agg(F.min_by(F.struct(*[F.col(c) for c in cols]), seq).alias("_r"),
                     F.min(seq).alias("_seq"))
                .select("transaction_id", "_seq", "_r.*"))

    auth = firsts("payment_intent_authorized", ["event_id", "ingestion_timestamp"]) \
        .withColumnRenamed("event_id", "auth_event_id") \
        .withColumnRenamed("ingestion_timestamp", "authorized_at").withColumnRenamed("_seq", "_aseq")
    cap = firsts("capture_succeeded", ["event_id", "charge_id", "ingestion_timestamp"]) \
        .withColumnRenamed("event_id", "capture_event_id") \
        .withColumnRenamed("ingestion_timestamp", "captured_at").withColumnRenamed("_seq", "_cseq")
    return (cap.join(auth, "transaction_id")
            .where(F.col("_cseq") > F.col("_aseq"))
            .select("transaction_id", "auth_event_id", "capture_event_id", "charge_id",
                    "authorized_at", "captured_at",
                    (F.col("captured_at").cast("long") - F.col("authorized_at").cast("long"))
                    .alias("seconds_to_capture")))


def late_with_capture(events: DataFrame, order: Sequence[str] = ARRIVAL_ORDER) -> DataFrame:
    """JN2: each late event (settlement, refund, chargeback) linked to its capture."""
    seq = arrival_seq(order)
    cap = (events.where(F.col("event_type") == "capture_succeeded")
           .groupBy("transaction_id")
           .agg(F.min_by(F.struct("charge_id", "ingestion_timestamp"), seq).alias("_c"))
           .select("transaction_id", F.col("_c.charge_id").alias("capture_charge_id"),
                   F.col("_c.ingestion_timestamp").alias("captured_at")))
    late = events.where(F.col("event_type").isin(
        "settlement_recorded", "refund_recorded", "chargeback_received"))
    return late.join(cap, "transaction_id", "left")


def fill_sparse_late(late: DataFrame, events: DataFrame, order: Sequence[str] = ARRIVAL_ORDER,
                     fill: Sequence[str] = ("merchant_id", "amount", "currency", "user_id",
                                            "payment_method", "country", "source_system")
                     ) -> DataFrame:
    """JN3: fill a v0 late event's missing fields from the transaction's authorisation.

    The authorisation side is reduced to one row per transaction first, so
    the left join cannot multiply late rows.
    """
    seq = arrival_seq(order)
    auth = (events.where(F.col("event_type") == "payment_intent_authorized")
            .groupBy("transaction_id")
            .agg(F.min_by(F.struct(*[F.col(c).alias(f"_a_{c}") for c in fill]), seq).alias("_a"))
            .select("transaction_id", "_a.*"))
    out = late.join(auth, "transaction_id", "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.col(f"_a_{c}")) for c in fill}) \
        .drop(*[f"_a_{c}" for c in fill])


# --- ST1 / ST2: lateness -------------------------------------------------------
def lateness(events: DataFrame) -> DataFrame:
    """ST1: ingestion minus event time in seconds, and its band."""
    lag = F.col("ingestion_timestamp").cast("long") - F.col("event_timestamp").cast("long")
    band = (F.when(lag.isNull(), "unknown")
            .when(lag <= 0, "on_time")
            .when(lag <= 5, "seconds")
            .when(lag < 86400, "minutes_to_hours")
            .otherwise("days"))
    return events.withColumn("lag_seconds", lag).withColumn("lateness_band", band)


def lateness_bands(events: DataFrame) -> DataFrame:
    """ST1 summary: deliveries, smallest and largest lag per band."""
    return lateness(events).groupBy("lateness_band").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("lag_seconds").alias("min_lag_seconds"),
        F.max("lag_seconds").alias("max_lag_seconds"))


def is_late(limit_seconds: int) -> Column:
    """ST2: is the event-time lag beyond the limit? Rows without both times are on time."""
    lag = F.col("ingestion_timestamp").cast("long") - F.col("event_timestamp").cast("long")
    return F.coalesce(lag > limit_seconds, F.lit(False))


def split_late(events: DataFrame, limit_seconds: int) -> tuple[DataFrame, DataFrame]:
    """ST2: (on_time, late) by event-time lag; late rows go to their own output, not dropped."""
    late_cond = is_late(limit_seconds)
    return events.where(~late_cond), events.where(late_cond)


# --- JN4: the intent -> charge -> refund / chargeback chain ------------------------------
def payment_chain(tables) -> DataFrame:
    """JN4: one row per intent with its charge and its children rolled up.

    Refunds and chargebacks are aggregated per charge *before* the joins, so
    a charge with many refunds never fans the intent row out; every join is
    then one-to-one on its key.
    """
    charges = tables["charges"].select(
        "intent_id", "charge_id", F.col("status").alias("charge_status"),
        F.col("amount_minor").alias("captured_minor"))
    refunds = tables["refunds"].groupBy("charge_id").agg(
        F.count(F.lit(1)).alias("refunds"), F.sum("amount_minor").alias("refunded_minor"))
    cbs = tables["chargebacks"].groupBy("charge_id").agg(
        F.count(F.lit(1)).alias("chargebacks"), F.sum("amount_minor").alias("charged_back_minor"))
    intents = tables["payment_intents"].select(
        "intent_id", "transaction_id", F.col("status").alias("intent_status"), "currency")
    return (intents.join(charges, "intent_id", "left")
            .join(refunds, "charge_id", "left")
            .join(cbs, "charge_id", "left")
            .select("intent_id", "transaction_id", "intent_status", "currency", "charge_id",
                    "charge_status", "captured_minor",
                    F.coalesce("refunds", F.lit(0)).cast("long").alias("refunds"),
                    F.coalesce("refunded_minor", F.lit(0)).cast("long").alias("refunded_minor"),
                    F.coalesce("chargebacks", F.lit(0)).cast("long").alias("chargebacks"),
                    F.coalesce("charged_back_minor", F.lit(0)).cast("long")
                    .alias("charged_back_minor")))
