"""DuckDB text for the oracle side of every registered query.

The oracle is written independently of the Spark code: it computes the
normalised payment log straight from ``orders`` (typed timestamps, no ISO
text round trip) and expresses first/last-per-key with ``row_number``
windows where Spark uses ``min_by`` / ``max_by`` aggregates.
"""

from __future__ import annotations

# The normalised payment log (FIXTURES.md section 2), as DuckDB CTEs ending in ``ev``.
EVENTS_CTE = r"""
o_ AS (
  SELECT o_orderkey AS k, o_custkey, CAST(o_totalprice AS DOUBLE) AS o_totalprice,
         CAST(o_orderdate AS TIMESTAMP) AS o_orderdate,
         ((o_orderkey % 1000003) * 2654435761) % 1000003 AS m
  FROM orders
), b_ AS (
  SELECT *, m % 100 < 85 AS ok, (m // 100) % 10 < 8 AS cap, (m // 1000) % 10 < 7 AS late,
         (m // 10000) % 100 AS r, o_orderdate + to_seconds(k % 86400) AS t0
  FROM o_
), s_ AS (
  SELECT b_.*, x.ord FROM b_, (VALUES (1),(2),(3),(4),(5)) x(ord)
  WHERE x.ord <= 2 OR (x.ord = 3 AND ok AND cap) OR (x.ord = 4 AND ok AND cap AND late)
     OR (x.ord = 5 AND ok AND cap AND late AND r >= 70 AND r < 95 AND k % 2 = 0)
), t_ AS (
  SELECT *,
    -- fixed values: event types, statuses and value lists of the derived log
    CASE WHEN ord = 1 THEN 'payment_intent_created'
         WHEN ord = 2 AND ok THEN 'payment_intent_authorized'
         WHEN ord = 2 THEN 'payment_intent_failed'
         WHEN ord = 3 THEN 'capture_succeeded'
         WHEN ord = 4 AND r < 70 THEN 'settlement_recorded'
         WHEN ord = 4 AND r < 95 THEN 'refund_recorded'
         WHEN ord = 4 THEN 'chargeback_received'
         WHEN k % 6 = 0 THEN 'settlement_recorded'
         WHEN k % 6 = 2 THEN 'refund_recorded'
         ELSE 'chargeback_received' END AS event_type,
    CASE ord WHEN 1 THEN t0 WHEN 2 THEN t0 + INTERVAL 1 SECOND WHEN 3 THEN t0 + INTERVAL 60 SECOND
             WHEN 4 THEN t0 + INTERVAL 1 HOUR ELSE t0 + INTERVAL 2 HOUR END AS ing0
  FROM s_
), c_ AS (
  SELECT t_.*, cc.copy_no FROM t_, (VALUES (0),(1),(2)) cc(copy_no)
  WHERE cc.copy_no = 0 OR (cc.copy_no = 1 AND (m + ord * 37) % 20 = 0)
     OR (cc.copy_no = 2 AND (m + ord * 53) % 50 = 1)
), ev AS (
  SELECT
    'txn_' || k AS transaction_id,
    'idem_' || k AS idempotency_key,
    'intent_' || k AS intent_id,
    CASE WHEN ord >= 3 THEN 'charge_' || k END AS charge_id,
    CASE WHEN event_type = 'refund_recorded' THEN 'refund_' || k || '_' || ord END AS refund_id,
    CASE WHEN event_type = 'chargeback_received' THEN 'chargeback_' || k END AS chargeback_id,
    CAST(CASE WHEN copy_no = 2 THEN 1 ELSE 0 END AS INTEGER) AS retry_attempt,
    'merch_' || (k % 20) AS merchant_id,
    o_totalprice / 320.0 AS amount,
    CAST(round_even(o_totalprice / 320.0 * CASE WHEN k % 8 = 4 THEN 1.0 ELSE 100.0 END, 0) AS BIGINT)
      AS amount_minor,
    ['USD','EGP','EUR','GBP','JPY','AUD','CAD','CHF'][k % 8 + 1] AS currency,
    'user_' || (10000 + o_custkey) AS user_id,
    ['US','GB','DE','EG','AE','CA'][k % 6 + 1] AS country,
    ['stripe_webhook','adyen_api','paypal_ipn','internal_pos'][k % 4 + 1] AS source_system,
    CASE WHEN k % 100 < 50 THEN 'credit_card' WHEN k % 100 < 75 THEN 'debit_card'
         WHEN k % 100 < 90 THEN 'apple_pay' WHEN k % 100 < 98 THEN 'paypal'
         ELSE 'bank_transfer' END AS payment_method,
    t0 AS original_transaction_timestamp,
    event_type,
    CASE event_type WHEN 'payment_intent_created' THEN 'pending'
         WHEN 'payment_intent_authorized' THEN 'authorized' WHEN 'payment_intent_failed' THEN 'failed'
         WHEN 'capture_succeeded' THEN 'captured' WHEN 'settlement_recorded' THEN 'settled'
         WHEN 'refund_recorded' THEN 'refunded' ELSE 'chargeback' END AS status,
    'evt_' || k || '_' || ord || CASE WHEN copy_no = 2 THEN '_r1' ELSE '' END AS event_id,
    CASE WHEN ord <= 2 THEN ing0
         WHEN ord = 3 THEN ing0 - to_seconds(1 + k % 5)
         WHEN ord = 4 THEN ing0 - to_days(CAST(2 + k % 44 AS INTEGER))
         ELSE ing0 - to_days(CAST(2 + k % 43 AS INTEGER)) END AS event_timestamp,
    CASE WHEN copy_no = 2 THEN ing0 + INTERVAL 1 SECOND ELSE ing0 END AS ingestion_timestamp,
    CASE WHEN event_type = 'payment_intent_failed' THEN
      CASE WHEN (m // 100) % 100 < 50 THEN 'insufficient_funds'
           WHEN (m // 100) % 100 < 75 THEN 'expired_card'
           WHEN (m // 100) % 100 < 90 THEN 'incorrect_cvc' ELSE 'suspected_fraud' END
    END AS failure_code,
    CAST(NULL AS VARCHAR) AS refund_reason,
    CAST(NULL AS BOOLEAN) AS is_partial,
    CAST(NULL AS VARCHAR) AS reason,
    k AS order_key,
    CAST(ord AS INTEGER) AS ord,
    CAST(copy_no AS INTEGER) AS copy_no
  FROM c_
)"""

# D1 on the log: first arrival per K3 (row_number form).
DEDUP_CTE = r"""
dd AS (
  SELECT * EXCLUDE (rn_) FROM (
    SELECT *, row_number() OVER (PARTITION BY transaction_id, idempotency_key, event_type
                                 ORDER BY ingestion_timestamp, ord, copy_no, event_id) AS rn_
    FROM ev) WHERE rn_ = 1
)"""


def with_events(body: str, dedup: bool = False, extra: str = "", changes: str = "") -> str:
    """The events CTE, then ``body``. ``changes`` (``expr AS column, ...``) replace columns of the log."""
    events = EVENTS_CTE.replace("), ev AS (", "), ev_ AS (" if changes else "), ev AS MATERIALIZED (")
    if changes:
        events += f",\nev AS MATERIALIZED (SELECT * REPLACE ({changes}) FROM ev_)"
    ctes = events + ("," + DEDUP_CTE if dedup else "") + ("," + extra if extra else "")
    return "WITH " + ctes.strip() + "\n" + body.strip()
