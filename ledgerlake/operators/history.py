"""Status-history rows (A4, B7, C7 input).

Kept apart from the stages module so both the batch flow and the streaming
store can build log rows from events.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.normalise import stable_uuid
from ledgerlake.schemas import ARRIVAL_ORDER, HISTORY_COLUMNS, K3

# event type -> the id column the log row keeps in entity mode
ENTITY_OF_EVENT = {
    "payment_intent_created": "intent_id",
    "payment_intent_authorized": "intent_id",
    "payment_intent_failed": "intent_id",
    "settlement_recorded": "intent_id",
    "capture_succeeded": "charge_id",
    "refund_recorded": "refund_id",
    "chargeback_received": "chargeback_id",
}
ENTITY_IDS = ["intent_id", "charge_id", "refund_id", "chargeback_id"]
# Event columns a log row is built from (besides the K3 and the arrival order).
HISTORY_INPUTS = ENTITY_IDS + ["status", "event_timestamp", "ingestion_timestamp",
                               "source_system", "payload"]


def history_rows(evs: DataFrame, entity_mode: str = "entity", with_id: bool = True,
                 keep: Sequence[str] = ()) -> DataFrame:
    """One ``payment_status_history`` row per delivery (before A4's K3 check).

    ``entity``: keep only the id of the entity the event is about, so the
    one-entity CHECK holds; ``literal``: keep every id, as the producer sends
    them (the CHECK then fails for captures and later events). The log id is a
    UUID-formatted hash of the K3, so redoing a batch yields the same ids. It
    takes the place of the producer's ``event_id``; ``keep`` names further
    columns to carry along.
    """
    if entity_mode == "entity":
        et = F.col("event_type")
        ids = {c: F.when(et.isin(*[e for e, k in ENTITY_OF_EVENT.items() if k == c]), F.col(c))
               for c in ENTITY_IDS}
    elif entity_mode == "literal":
        ids = {c: F.col(c) for c in ENTITY_IDS}
    else:
        raise ValueError(f"unknown entity_mode {entity_mode!r}")
    cols = {"event_id": stable_uuid(*K3) if with_id else F.lit(None).cast("string"), **ids}
    extra = [c for c in ARRIVAL_ORDER if c not in HISTORY_COLUMNS and c in evs.columns] + list(keep)
    return evs.withColumns(cols).select(*HISTORY_COLUMNS, *extra)
