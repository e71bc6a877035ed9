"""The sending side of every feed, for tests and replays: messages made from the derived log.

The producer's events, its two older shapes, the connector's change records
and message files that a file stream source replays.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.schemas import PRODUCER_FIELDS, RAW_EVENT_FIELDS, TABLES, V0_EVENT_SCHEMA
from ledgerlake.session import open_writers
from ledgerlake.sources.events import CHANGE_TOPIC

#: Folders of message files: one for each chunk.
CHUNK = "_chunk"


def to_messages(raw: DataFrame, fields=PRODUCER_FIELDS) -> DataFrame:
    """The sending side: one JSON object per event in a ``value`` column (no key).

    Null fields are written as JSON null, as ``json.dumps`` of the producer's
    dict does; fields the producer never sets are left out.
    """
    cols = [c for c in raw.columns if c not in RAW_EVENT_FIELDS]   # order columns ride along
    return raw.select(F.to_json(F.struct(*[F.col(f) for f in fields]),
                                {"ignoreNullFields": "false"}).alias("value"), *cols)


def _ts_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def to_change_messages(history: DataFrame, topic: str = CHANGE_TOPIC) -> DataFrame:
    """The connector's output for log rows: flattened new row state as JSON text."""
    cols = []
    for f in TABLES["payment_status_history"].schema.fields:
        c = F.col(f.name)
        cols.append((_ts_text(c) if isinstance(f.dataType, T.TimestampType) else c).alias(f.name))
    value = F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
    return history.select(F.lit(topic).alias("topic"), value.alias("value"))


def write_message_files(raw: DataFrame, path: str, chunk: Column, n_chunks: int,
                        files_per_chunk: int = 8) -> str:
    """Write raw deliveries as JSON-lines message files, one chunk after the other.

    Used to replay a derived log through a file stream source, which takes
    files by modification time. ``chunk`` (0 .. n_chunks - 1) says which micro-batch
    a delivery comes with. The deliveries are made once: a task writes each chunk's
    rows, in no particular order and with no shuffle or sort before it, to a gzip
    file in the chunk's folder, and the files' times are then set in the order of
    the chunks. There are at most ``files_per_chunk`` tasks, so a batch is read by
    that many at most: give more files for larger logs. Where fewer hold rows, empty
    ones follow, so a stream that takes ``files_per_chunk`` files a trigger reads one
    chunk a batch. The order columns (``ord``, ``copy_no``) travel as two extra JSON keys.
    """
    spark = raw.sparkSession
    fields = [F.col(c) for c in PRODUCER_FIELDS + ["ord", "copy_no"]]
    value = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    rows = raw.select(value.alias("value"), chunk.alias(CHUNK)).where(F.col(CHUNK).between(0, n_chunks - 1))
    with open_writers(spark, n_chunks):   # speed before size: the files are read once
        (rows.coalesce(files_per_chunk).write.mode("append").option("compression", "gzip")
         .option("zlib.compress.level", "BEST_SPEED").partitionBy(CHUNK).text(path))
    _in_order(spark, [f"{path}/{CHUNK}={i}" for i in range(n_chunks)], files_per_chunk)
    return path


def _in_order(spark: SparkSession, folders: list[str], files: int) -> None:
    """Each folder filled up with empty files to ``files``, and its files later by a second than those of the one before."""
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    now = time.time_ns() // 1_000_000_000 * 1000
    for i, folder in enumerate(folders):
        at = Path(folder)
        fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        fs.mkdirs(at)
        have = [f.getPath() for f in fs.listStatus(at) if not f.getPath().getName().startswith(("_", "."))]
        for j in range(files - len(have)):
            have.append(Path(f"{folder}/empty-{j:05d}.txt.gz"))
            fs.create(have[-1]).close()
        when = now + 1000 * (i - len(folders))
        for f in have:
            fs.setTimes(f, when, -1)
        if any(f.getModificationTime() != when for f in fs.listStatus(at) if f.isFile()):
            raise OSError(f"{folder}: the store keeps no modification times, so files cannot be replayed in order")


# --- older shapes, derived from current events (B10, D6, JN3 inputs) ---------------------
def to_v0_messages(raw: DataFrame) -> DataFrame:
    """Current deliveries rewritten in the v0 Kafka shape.

    Authorisations and captures keep every field; refunds and chargebacks
    become the sparse late shape (ids, type, times and a note only).
    Settlements and creations have no v0 type and are left out.
    """
    v0_type = (F.when(F.col("event_type") == "payment_intent_authorized", "AUTHORIZATION")
               .when(F.col("event_type") == "capture_succeeded", "CAPTURE")
               .when(F.col("event_type") == "refund_recorded", "REFUND")
               .when(F.col("event_type") == "chargeback_received", "CHARGEBACK"))
    late = F.col("event_type").isin("refund_recorded", "chargeback_received")
    full = lambda c: F.when(~late, F.col(c))
    rest = [c for c in raw.columns if c not in RAW_EVENT_FIELDS]
    out = raw.where(v0_type.isNotNull()).select(
        F.col("event_id"), F.col("transaction_id"), full("merchant_id").alias("merchant_id"),
        F.when(~late, F.regexp_extract("user_id", r"(\d+)$", 1).cast("long")).alias("user_id"),
        full("payment_method").alias("payment_method"), full("country").alias("country"),
        full("amount").alias("amount"), full("currency").alias("currency"),
        v0_type.alias("event_type"), full("source_system").alias("source_system"),
        F.when(~late, F.concat(F.lit("ch_"), F.substring(F.sha2(F.col("transaction_id"), 256), 1, 14)))
        .alias("processor_reference"),
        F.col("event_timestamp"), F.col("ingestion_timestamp"),
        F.when(late, F.lit("LATE_ARRIVING_DATA")).alias("metadata_note"),
        *rest)
    assert [f.name for f in V0_EVENT_SCHEMA.fields] == out.columns[:len(V0_EVENT_SCHEMA.fields)]
    return out


def to_v1_messages(raw: DataFrame) -> DataFrame:
    """Current deliveries in the v1 shape: no event type, int user id, one ``timestamp``."""
    rest = [c for c in raw.columns if c not in RAW_EVENT_FIELDS]
    return raw.select(
        "transaction_id", "idempotency_key", "merchant_id", "amount", "currency",
        F.regexp_extract("user_id", r"(\d+)$", 1).cast("long").alias("user_id"),
        "country", "source_system", "payment_method", "status", "event_id",
        F.col("event_timestamp").alias("timestamp"), "failure_code", *rest)
