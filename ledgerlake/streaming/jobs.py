"""Structured Streaming jobs (ST2, ST3, ST4, ST6, ST7) and log sinks.

Streams read JSON messages with an explicit schema and are normalised with
the same column functions as batch. Every stream writes through
``foreachBatch`` into one folder per batch, which a redo overwrites. There is no
watermark: the reference's keys conflict for ever, deliveries may come in any
order and without a readable time, so any watermark would drop or repeat rows.
What would be streaming state is a fold over the batches' folders instead.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerlake.functions.normalise import arrival_seq, normalise_events, parse_iso_timestamp, stable_uuid
from ledgerlake.operators.dedup import dedup_history, dedup_raw
from ledgerlake.operators.history import HISTORY_INPUTS, history_rows
from ledgerlake.operators import validate
from ledgerlake.operators.lifecycle import is_late
from ledgerlake.operators.reports import transition_counts
from ledgerlake.schemas import ARRIVAL_ORDER, K2, K3, RAW_EVENT_SCHEMA
from ledgerlake.sources.events import parse_event_messages, read_change_feed
from ledgerlake.streaming.keyed import KeyedLog
from ledgerlake.streaming.store import FoldedStore, read_or_none


# --- inputs ------------------------------------------------------------------------
def message_stream(spark: SparkSession, path: str, max_files_per_trigger: int = 8) -> DataFrame:
    """A1 as a stream: JSON message files -> normalised events, as batch normalises them."""
    msgs = spark.readStream.option("maxFilesPerTrigger", str(max_files_per_trigger)).text(path).select("value")
    schema = T.StructType(RAW_EVENT_SCHEMA.fields + [T.StructField("ord", T.IntegerType()),
                                                     T.StructField("copy_no", T.IntegerType())])
    return normalise_events(parse_event_messages(msgs, schema=schema))


def _start(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str,
           available_now: bool) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


# --- ST3: streaming first-per-K3 -------------------------------------------------------
def start_dedup_stream(events: DataFrame, path: str, checkpoint: str, available_now: bool = True,
                       columns: Sequence[str] = ("status",)) -> StreamingQuery:
    """ST3: the first delivery of each K3, for ever (ON CONFLICT DO NOTHING).

    A batch is folded to one row per K3 (partial aggregation first, so a
    storm of copies shrinks map-side) and only keys that no earlier batch wrote
    are appended; of the log only folders that may hold one of the batch's
    keys are read (:class:`KeyedLog`).
    """
    def fold(batch: DataFrame) -> DataFrame:
        return dedup_history(batch, columns=columns).select(*K3, *columns)

    def sink(batch: DataFrame, batch_id: int) -> None:
        KeyedLog(batch.sparkSession, path, K3, fold(batch).schema).append_absent(batch, fold, batch_id)

    return _start(events, sink, checkpoint, available_now)


# --- ST4: streaming upsert into the folded store ----------------------------------------
def start_upsert_stream(events: DataFrame, store: FoldedStore, checkpoint: str,
                        available_now: bool = True, applied_at=None) -> StreamingQuery:
    """ST4: every micro-batch folded into all tables at once.

    A batch replayed after a failure overwrites its own folder (source
    offsets come from the checkpoint), so it is applied once.
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        store.apply_events(batch, batch_id, applied_at=applied_at)

    return _start(events, sink, checkpoint, available_now)


# --- ST7: streaming life-cycle state -----------------------------------------------------
def lifecycle_delta(events: DataFrame, order: Sequence[str] = ARRIVAL_ORDER) -> DataFrame:
    """One batch's last status, its arrival and the delivery count per transaction."""
    seq = arrival_seq(order)
    return events.groupBy("transaction_id").agg(
        F.max_by(F.col("status"), seq).alias("status"), F.max(seq).alias("last_seq"),
        F.count(F.lit(1)).alias("deliveries"))


def start_lifecycle_stream(events: DataFrame, path: str, checkpoint: str,
                           available_now: bool = True) -> StreamingQuery:
    """ST7: write each batch's delta under ``path/batch=<id>``; read with :func:`read_lifecycle`."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        lifecycle_delta(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return _start(events, sink, checkpoint, available_now)


def read_lifecycle(spark: SparkSession, path: str) -> DataFrame:
    """Current state per transaction: the status of its latest arrival, deliveries summed.

    Rows without a readable time, and rows that come days late, count like all others.
    """
    return spark.read.parquet(path).groupBy("transaction_id").agg(
        F.max_by(F.col("status"), F.col("last_seq")).alias("status"),
        F.sum("deliveries").alias("deliveries"))


# --- JN1 as a stream ------------------------------------------------------------------------
#: Transaction of a heartbeat row: it only moves the watermark on.
HEARTBEAT = ""


def _interval_join(left: DataFrame, l: str, right: DataFrame, r: str, wait: str, arrived: str, delay: str,
                   order: Sequence[str]) -> DataFrame:
    """Left rows with each right row of their transaction that arrives at most ``wait`` before or after; alone
    once none can come any more. Columns get the sides' letters in front."""
    def side(events: DataFrame, tag: str) -> DataFrame:
        columns = ["transaction_id", "event_id", "charge_id", "ingestion_timestamp", arrived]
        return events.withWatermark(arrived, delay).select(
            *[F.col(c).alias(f"{tag}_{c}") for c in columns], arrival_seq(order).alias(f"{tag}_seq"))

    span = F.expr(f"INTERVAL {wait}")
    mine, other = F.col(f"{l}_{arrived}"), F.col(f"{r}_{arrived}")
    return side(left, l).join(
        side(right, r), (F.col(f"{l}_transaction_id") == F.col(f"{r}_transaction_id"))
        & (other >= mine - span) & (other <= mine + span), "left_outer")


def start_capture_join_stream(authorisations: DataFrame, captures: DataFrame, path: str, checkpoint: str, wait: str,
                              arrived: str = "arrived_at", delay: str = "0 seconds", available_now: bool = True,
                              order: Sequence[str] = ARRIVAL_ORDER) -> StreamingQuery:
    """JN1 over two streams: an interval join with a watermark on each side.

    The watermarks run on ``arrived``, the time at which the feed took a
    message (a topic's append time), not on event or ingestion time: these come
    in any order and may be unreadable, the arrival only as far behind as
    ``delay`` says, so no delivery is dropped as late. A capture waits for
    an authorisation that arrives at most ``wait`` before or after it; joined
    pairs are written under ``_table=matched``, captures whose time is over
    under ``_table=unmatched``. State is bounded by ``wait``. A heartbeat on
    both streams closes a feed that ends.
    """
    joined = _interval_join(captures, "c", authorisations, "a", wait, arrived, delay, order)

    def sink(batch: DataFrame, batch_id: int) -> None:
        rows = batch.where(F.col("c_transaction_id") != HEARTBEAT).withColumn(
            "_table", F.when(F.col("a_transaction_id").isNull(), "unmatched").otherwise("matched"))
        rows.write.mode("overwrite").partitionBy("_table").parquet(f"{path}/batch={batch_id}")

    return _start(joined, sink, checkpoint, available_now)


def read_capture_links(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(links, unmatched): :func:`lifecycle.capture_with_authorisation` over the joined pairs, and captures left alone."""
    rows = spark.read.parquet(path)
    first = (rows.where("_table = 'matched'").groupBy(F.col("c_transaction_id").alias("transaction_id")).agg(
        F.min_by(F.struct(F.col("a_event_id").alias("auth_event_id"), F.col("a_ingestion_timestamp").alias("authorized_at")),
                 F.col("a_seq")).alias("a"), F.min("a_seq").alias("a_seq"),
        F.min_by(F.struct(F.col("c_event_id").alias("capture_event_id"), F.col("c_charge_id").alias("charge_id"),
                          F.col("c_ingestion_timestamp").alias("captured_at")), F.col("c_seq")).alias("c"),
        F.min("c_seq").alias("c_seq")))
    links = first.where("c_seq > a_seq").select(
        "transaction_id", "a.auth_event_id", "c.capture_event_id", "c.charge_id", "a.authorized_at", "c.captured_at",
        (F.col("c.captured_at").cast("long") - F.col("a.authorized_at").cast("long")).alias("seconds_to_capture"))
    left = rows.where("_table = 'unmatched'").select(
        F.col("c_transaction_id").alias("transaction_id"), F.col("c_event_id").alias("capture_event_id"), "c_seq.copy_no")
    return links, left


# --- ST7 with timers: authorisations open for too long ---------------------------------------
def start_open_stream(authorisations: DataFrame, captures: DataFrame, path: str, checkpoint: str, limit: str,
                      arrived: str = "arrived_at", delay: str = "0 seconds", available_now: bool = True,
                      order: Sequence[str] = ARRIVAL_ORDER) -> list[StreamingQuery]:
    """ST7: report each authorisation that has waited ``limit`` for its capture; captures close it however late.

    The authorisation is held as keyed state until its capture comes or the
    watermark passes arrival + limit, which is the timer; then it is written
    under ``reports``. The captures' keys go to ``captures``, so that a capture
    that comes after the report still closes it (:func:`read_open`).
    """
    joined = _interval_join(authorisations, "a", captures, "c", limit, arrived, delay, order)

    def report(batch: DataFrame, batch_id: int) -> None:
        rows = batch.where(F.col("c_transaction_id").isNull() & (F.col("a_transaction_id") != HEARTBEAT))
        rows.select(F.col("a_transaction_id").alias("transaction_id"), F.col("a_event_id").alias("event_id"), "a_seq.copy_no",
                    F.col(f"a_{arrived}").alias("arrived_at")).write.mode("overwrite").parquet(f"{path}/reports/batch={batch_id}")

    def close(batch: DataFrame, batch_id: int) -> None:
        batch.where(F.col("transaction_id") != HEARTBEAT).select("transaction_id").distinct() \
            .write.mode("overwrite").parquet(f"{path}/captures/batch={batch_id}")

    return [_start(joined, report, f"{checkpoint}/reports", available_now),
            _start(captures, close, f"{checkpoint}/captures", available_now)]


def read_open(spark: SparkSession, path: str) -> DataFrame:
    """Reported authorisations (transaction_id, event_id, copy_no, arrived_at) and whether a capture closed them since."""
    reports = read_or_none(spark, f"{path}/reports/batch=*")
    if reports is None:
        reports = spark.createDataFrame([], "transaction_id string, event_id string, copy_no int, arrived_at timestamp")
    captured = read_or_none(spark, f"{path}/captures/batch=*")
    if captured is None:
        captured = spark.createDataFrame([], "transaction_id string")
    closed = captured.select("transaction_id").distinct().withColumn("closed", F.lit(True))
    return reports.join(closed, "transaction_id", "left").select(
        "transaction_id", "event_id", "copy_no", "arrived_at", F.coalesce("closed", F.lit(False)).alias("closed_late"))


# --- F2 / G1 kept up over batches ----------------------------------------------------------
def apply_transitions(batch: DataFrame, path: str, batch_id: int, order: Sequence[str] = ARRIVAL_ORDER) -> None:
    """F2 as a running sum: what one batch of deliveries changes in the transition counts.

    Deliveries come in any order. One that falls between two earlier ones takes
    their transition away and adds two, so the change of a batch is the counts
    over its transactions with it, less those without it. Only the earlier
    deliveries of its own transactions are read, from folders that may hold
    them; the change is one row a transition. Copies and hot transactions are
    handled as in :func:`reports.transition_counts`.
    """
    rows = batch.select("transaction_id", "status", *order)
    log = KeyedLog(batch.sparkSession, f"{path}/deliveries", ["transaction_id"], rows.schema)
    log.write(rows, batch_id)
    new = log.batch(batch_id)
    old = log.holding(new, batch_id).drop("batch")
    counts = lambda df, sign: transition_counts(df, order).select(
        "transition", (F.lit(sign) * F.col("n")).alias("n"))
    change = counts(old.unionByName(new), 1).unionAll(counts(old, -1)).groupBy("transition").agg(F.sum("n").alias("n"))
    change.where("n <> 0").write.mode("overwrite").parquet(f"{path}/changes/of={batch_id}")


def start_transition_stream(events: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """F2 / G1 over a live stream; read the counts with :func:`read_transitions`."""
    return _start(events, lambda batch, batch_id: apply_transitions(batch, path, batch_id), checkpoint, available_now)


def read_transitions(spark: SparkSession, path: str) -> DataFrame:
    """(transition, n) over all deliveries so far."""
    changes = read_or_none(spark, f"{path}/changes/of=*")
    if changes is None:
        changes = spark.createDataFrame([], "transition string, n long")
    return changes.groupBy("transition").agg(F.sum("n").alias("n")).where("n <> 0")


# --- C5-C10 / C12 kept up over batches -----------------------------------------------------
def apply_rule_facts(tables: Mapping[str, DataFrame], path: str, batch_id: int) -> None:
    """C12 as a running sum: what one batch of table rows changes in the constraint report.

    A batch says (rule, key, children, parent); earlier batches' facts on the
    same keys are read from folders that may hold them, and the change is the
    violations with the batch less those without it, both from one aggregation
    by (rule, key); keys that only earlier batches have change nothing. So a
    reference whose parent comes later stops being an orphan, and a key written
    twice counts from its second row, in any order of batches. Row rules have no
    key and simply add up.
    """
    facts, rules = validate.rule_facts(tables)
    log = KeyedLog(facts.sparkSession, f"{path}/facts", ["rule", "key"], facts.schema)
    log.write(facts, batch_id, dealt=True)
    new = log.batch(batch_id)
    old = log.opened(new.where("key is not null"), batch_id).drop("batch")
    (validate.violation_changes(old, new, rules).where("violations <> 0")
     .write.mode("overwrite").parquet(f"{path}/changes/of={batch_id}"))


def read_constraint_report(spark: SparkSession, path: str, tables: Mapping[str, Sequence[str]]) -> DataFrame:
    """The report over all batches so far; ``tables`` gives each table's columns."""
    changes = read_or_none(spark, f"{path}/changes/of=*")
    if changes is None:
        changes = spark.createDataFrame([], "rule string, violations long")
    return validate.report_rows(changes.groupBy("rule").agg(F.sum("violations").alias("violations")),
                                validate.rule_labels(tables))


# --- ST2 in a stream: late rows to their own output ---------------------------------------
def start_late_split_stream(events: DataFrame, path: str, checkpoint: str, limit_seconds: int,
                            available_now: bool = True) -> StreamingQuery:
    """ST2: split every micro-batch into on-time and late rows by event-time lag.

    Late events reach their own output (``_table=late``). Both outputs are
    written in one job per batch, which reads each row once.
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        output = F.when(is_late(limit_seconds), "late").otherwise("on_time")
        (batch.withColumn("_table", output).write.mode("overwrite").option("compression", "zstd")
         .partitionBy("_table").parquet(f"{path}/batch={batch_id}"))

    return _start(events, sink, checkpoint, available_now)


# --- ST6: the change feed as a stream -----------------------------------------------------
def start_change_stream(messages: DataFrame, path: str, checkpoint: str,
                        available_now: bool = True) -> StreamingQuery:
    """A2 / ST6: change messages -> typed log rows, one folder per batch."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        read_change_feed(batch).write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/batch={batch_id}")

    return _start(messages, sink, checkpoint, available_now)


# --- A4 / A6: log sinks on plain tables --------------------------------------------------
def append_status_history(batch: DataFrame, path: str, batch_id: int, entity_mode: str = "entity",
                          order: Sequence[str] = ARRIVAL_ORDER) -> None:
    """A4: append the batch's first delivery per K3 to the log at ``path``.

    Keys that an earlier batch wrote stay as they are. Read the whole log with
    ``spark.read.parquet(path)``; ``batch`` says which batch wrote a row.
    """
    def fold(events: DataFrame) -> DataFrame:
        return encoded(history_rows(dedup_history(events, order, columns=HISTORY_INPUTS), entity_mode))

    def fold_new(events: DataFrame, known: DataFrame) -> DataFrame:
        # a key that the log has comes first, and goes with its row
        both = events.withColumn("_new", F.lit(1)).unionByName(known.withColumn("_new", F.lit(0)), allowMissingColumns=True)
        first = dedup_history(both, ["_new", *order], columns=["_new", *HISTORY_INPUTS])
        return encoded(history_rows(first.where("_new = 1"), entity_mode))

    KeyedLog(batch.sparkSession, path, K3, fold(batch).schema).append_absent(batch, fold, batch_id, fold_new)


#: Columns that a lookup may ask for.
LOOKUP_IDS = ["transaction_id", "event_id", "intent_id", "charge_id", "refund_id", "chargeback_id"]
#: Folders of the log's lookup layout.
LOG_BUCKETS = 64


def log_bucket(transaction_id: Column) -> Column:
    return F.pmod(F.xxhash64(transaction_id), F.lit(LOG_BUCKETS)).cast("int")


def encoded(log: DataFrame) -> DataFrame:
    """The log with a payload that is still a struct written as JSON text."""
    if not isinstance(log.schema["payload"].dataType, T.StructType):
        return log
    return log.withColumn("payload", F.to_json("payload", {"ignoreNullFields": "false"}))


def write_status_log(history: DataFrame, path: str, by: str = "transaction",
                     make: Callable[[DataFrame], DataFrame] | None = None) -> str:
    """The status log laid out for its reads.

    ``by="ids"``: no folders; Parquet Bloom filters on the transaction and entity
    ids, so a lookup by any of them reads only row groups that may hold it,
    and a miss none, however many files there are. ``by="transaction"``: a folder per hash bucket of the transaction, so a
    lookup opens one; rows lie sorted by transaction, so its filter skips row
    groups by their statistics. ``by="event_time"``: a folder per event month,
    for reads of a span of time. Rows are range-split on (folder,
    transaction, id) first: a folder with a third of the log is written by
    several tasks.

    ``make`` makes log rows of what is given, behind the split: raw deliveries,
    each the first of its K3, are less to shuffle than the rows with their payload.
    """
    log_id, at = F.col("event_id"), F.col("event_timestamp")
    if make is not None:
        log_id, at = stable_uuid(*K3), parse_iso_timestamp(at)
    make = make or (lambda rows: rows)
    if by == "ids":
        order = ["transaction_id", "event_id"]
        rows = make(history.repartitionByRange("transaction_id", log_id)).sortWithinPartitions(*order)
        writer = rows.write.mode("overwrite").option("compression", "zstd")
        for c in LOOKUP_IDS:
            writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
        writer.parquet(path)
        return path
    folder, value = (("txn_bucket", log_bucket(F.col("transaction_id"))) if by == "transaction"
                     else ("event_month", F.date_format(at, "yyyy-MM")))
    order = [folder, "transaction_id", "event_id"]
    split = make(history.repartitionByRange(value, "transaction_id", log_id))
    if by != "transaction":
        value = F.date_format("event_timestamp", "yyyy-MM")
    rows = split.withColumn(folder, value).sortWithinPartitions(*order)
    rows.write.mode("overwrite").option("compression", "zstd").partitionBy(folder).parquet(path)
    return path


def land_raw(events: DataFrame, order: Sequence[str] = ARRIVAL_ORDER) -> DataFrame:
    """``raw_payment_events`` rows -- first delivery per K2, ``processed`` false."""
    return landed_rows(dedup_raw(events, order, columns=["event_type", "payload"]))


def landed_rows(first: DataFrame) -> DataFrame:
    """Landing table rows of deliveries that are the first of their K2."""
    return first.select(stable_uuid(*K2).alias("event_id"), "transaction_id", "idempotency_key",
                        "event_type", "payload", F.col("ingestion_timestamp"),
                        F.lit(False).alias("processed"))
