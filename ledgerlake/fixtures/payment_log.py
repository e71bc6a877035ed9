"""The payment log derived from the driver's ``orders`` table.

The driver's data has no payment life cycle, so each order becomes one
transaction whose events, copies and timestamps follow from plain
arithmetic on the order key (FIXTURES.md section 2). The result has the
producer's raw event shape: flat fields, amounts as doubles, timestamps as
ISO-8601 text with a UTC offset.

Everything is narrow: one scan of ``orders`` (4 columns), two ``explode``
generators and projections. No shuffle (but for a table of too few splits, see
:func:`payment_events`), no Python; the row count grows linearly with ``orders``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.schemas import RAW_EVENT_FIELDS

# --- fixed values of the derivation (FIXTURES.md section 2) -------------------
HASH_MULTIPLIER = 2654435761
HASH_MODULUS = 1000003
CURRENCIES = ["USD", "EGP", "EUR", "GBP", "JPY", "AUD", "CAD", "CHF"]
COUNTRIES = ["US", "GB", "DE", "EG", "AE", "CA"]
SOURCE_SYSTEMS = ["stripe_webhook", "adyen_api", "paypal_ipn", "internal_pos"]
# payment method by k % 100: below 50, 75, 90, 98, else
PAYMENT_METHOD_CUTS = [(50, "credit_card"), (75, "debit_card"), (90, "apple_pay"), (98, "paypal")]
PAYMENT_METHOD_REST = "bank_transfer"
# failure code by dig(100) % 100: below 50, 75, 90, else
FAILURE_CODE_CUTS = [(50, "insufficient_funds"), (75, "expired_card"), (90, "incorrect_cvc")]
FAILURE_CODE_REST = "suspected_fraud"
AMOUNT_DIVISOR = 320.0
# ------------------------------------------------------------------------------


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _cuts(cuts, rest: str, x: Column) -> Column:
    expr = None
    for bound, label in cuts:
        expr = F.when(x < bound, label) if expr is None else expr.when(x < bound, label)
    return expr.otherwise(rest)


def _iso(ts: Column) -> Column:
    """UTC wall-clock timestamp -> ISO-8601 text with a ``+00:00`` offset."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))


def _secs(n) -> Column:
    return F.make_dt_interval(secs=F.lit(n) if isinstance(n, int) else n)


def payment_events(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """Raw payment deliveries, one row per delivered message.

    Besides the producer's fields the frame carries ``order_key``, ``ord``
    (lifecycle step 1-5) and ``copy_no`` (0 original, 1 exact copy, 2 retry):
    with ``ingestion_timestamp`` they give the arrival order. Where the scan
    gives fewer splits than ``partitions``, the orders (4 narrow columns) are
    dealt over that many tasks, before each becomes several wide rows.
    """
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    if partitions and orders.rdd.getNumPartitions() < partitions:
        orders = orders.repartition(partitions)
    k = F.col("o_orderkey")
    base = orders.select(
        k.alias("order_key"),
        "o_custkey", "o_totalprice",
        # (k mod p) * a mod p equals k * a mod p and cannot overflow
        (((k % HASH_MODULUS) * HASH_MULTIPLIER) % HASH_MODULUS).alias("m"),
        (F.col("o_orderdate").cast("timestamp_ntz") + _secs(k % 86400)).alias("t0"),
    )
    m = F.col("m")
    dig = lambda n: F.floor(m / n).cast("long")
    base = base.select(
        "*",
        (m % 100 < 85).alias("ok"),
        (dig(100) % 10 < 8).alias("cap"),
        (dig(1000) % 10 < 7).alias("late"),
        (dig(10000) % 100).alias("r"),
    )
    kk = F.col("order_key")
    ok, cap, late, r, ord_ = F.col("ok"), F.col("cap"), F.col("late"), F.col("r"), F.col("ord")
    has_ord = (
        (ord_ <= 2)
        | ((ord_ == 3) & ok & cap)
        | ((ord_ == 4) & ok & cap & late)
        | ((ord_ == 5) & ok & cap & late & (r >= 70) & (r < 95) & (kk % 2 == 0))
    )
    steps = base.select("*", F.explode(F.array(*[F.lit(i) for i in range(1, 6)])).alias("ord")) \
        .where(has_ord)
    event_type = (
        F.when(ord_ == 1, "payment_intent_created")
        .when((ord_ == 2) & ok, "payment_intent_authorized")
        .when(ord_ == 2, "payment_intent_failed")
        .when(ord_ == 3, "capture_succeeded")
        .when((ord_ == 4) & (r < 70), "settlement_recorded")
        .when((ord_ == 4) & (r < 95), "refund_recorded")
        .when(ord_ == 4, "chargeback_received")
        .when(kk % 6 == 0, "settlement_recorded")
        .when(kk % 6 == 2, "refund_recorded")
        .otherwise("chargeback_received")
    )
    t0 = F.col("t0")
    ingest = (F.when(ord_ == 1, t0)
              .when(ord_ == 2, t0 + _secs(1))
              .when(ord_ == 3, t0 + _secs(60))
              .when(ord_ == 4, t0 + _secs(3600))
              .otherwise(t0 + _secs(7200)))
    event_ts = (F.when(ord_ <= 2, ingest)
                .when(ord_ == 3, ingest - _secs(1 + kk % 5))
                .when(ord_ == 4, ingest - F.make_dt_interval(days=2 + kk % 44))
                .otherwise(ingest - F.make_dt_interval(days=2 + kk % 43)))
    steps = steps.select("*", event_type.alias("event_type"),
                         ingest.alias("ingest_ts"), event_ts.alias("event_ts"))

    copy_no = F.col("copy_no")
    has_copy = ((copy_no == 0)
                | ((copy_no == 1) & ((m + ord_ * 37) % 20 == 0))
                | ((copy_no == 2) & ((m + ord_ * 53) % 50 == 1)))
    rows = steps.select("*", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("copy_no")) \
        .where(has_copy)

    et = F.col("event_type")
    kstr = kk.cast("string")
    status = (F.when(et == "payment_intent_created", "pending")
              .when(et == "payment_intent_authorized", "authorized")
              .when(et == "payment_intent_failed", "failed")
              .when(et == "capture_succeeded", "captured")
              .when(et == "settlement_recorded", "settled")
              .when(et == "refund_recorded", "refunded")
              .otherwise("chargeback"))
    event_id = F.concat(F.lit("evt_"), kstr, F.lit("_"), ord_.cast("string"))
    is_retry = copy_no == 2
    out = rows.select(
        F.concat(F.lit("txn_"), kstr).alias("transaction_id"),
        F.concat(F.lit("idem_"), kstr).alias("idempotency_key"),
        F.concat(F.lit("intent_"), kstr).alias("intent_id"),
        F.when(ord_ >= 3, F.concat(F.lit("charge_"), kstr)).alias("charge_id"),
        F.when(et == "refund_recorded",
               F.concat(F.lit("refund_"), kstr, F.lit("_"), ord_.cast("string"))).alias("refund_id"),
        F.when(et == "chargeback_received", F.concat(F.lit("chargeback_"), kstr)).alias("chargeback_id"),
        F.when(is_retry, 1).otherwise(0).alias("retry_attempt"),
        F.concat(F.lit("merch_"), (kk % 20).cast("string")).alias("merchant_id"),
        (F.col("o_totalprice").cast("double") / AMOUNT_DIVISOR).alias("amount"),
        _pick(CURRENCIES, kk % 8).alias("currency"),
        F.concat(F.lit("user_"), (F.col("o_custkey") + 10000).cast("string")).alias("user_id"),
        _pick(COUNTRIES, kk % 6).alias("country"),
        _pick(SOURCE_SYSTEMS, kk % 4).alias("source_system"),
        _cuts(PAYMENT_METHOD_CUTS, PAYMENT_METHOD_REST, kk % 100).alias("payment_method"),
        _iso(t0).alias("original_transaction_timestamp"),
        et.alias("event_type"),
        status.alias("status"),
        F.when(is_retry, F.concat(event_id, F.lit("_r1"))).otherwise(event_id).alias("event_id"),
        _iso(F.col("event_ts")).alias("event_timestamp"),
        _iso(F.when(is_retry, F.col("ingest_ts") + _secs(1)).otherwise(F.col("ingest_ts")))
        .alias("ingestion_timestamp"),
        F.when(et == "payment_intent_failed",
               _cuts(FAILURE_CODE_CUTS, FAILURE_CODE_REST, dig(100) % 100)).alias("failure_code"),
        F.lit(None).cast("string").alias("refund_reason"),
        F.lit(None).cast("boolean").alias("is_partial"),
        F.lit(None).cast("string").alias("reason"),
        kk.alias("order_key"),
        ord_.alias("ord"),
        copy_no.alias("copy_no"),
    )
    assert out.columns[:len(RAW_EVENT_FIELDS)] == RAW_EVENT_FIELDS
    return out
