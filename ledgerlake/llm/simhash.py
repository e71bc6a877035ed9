"""Document fingerprints: SimHash over weighted word-pair hashes, and a search by permuted block tables.

Terms are words and pairs of neighbouring words (a pair weighs twice a word,
each occurrence counts). Every term's 128-bit hash votes on 128 signed sums;
the fingerprint is their signs, as 32 hex digits. The likeness of two
fingerprints is the share of equal bits, 0 to 1.

The search cuts fingerprints into ``radius + SPARE`` blocks. Two fingerprints
within the radius agree on at least ``SPARE`` whole blocks, so a table for
every choice of ``SPARE`` blocks, keyed by these blocks (the permuted leading
bits), meets each such pair in at least one table. Equal fingerprints are one
entry. Queries meet entries in equi-joins that AQE splits where they are
skewed; a stated query set against all rows, never all pairs. A bitmap of the
queries' keys (fixed size, so it only saves less in a large corpus) keeps
entries' keys that no query has out of the shuffle.

The query set are the documents whose id is divisible by ``ASK``; they are
searched for in all rows within ``RADIUS`` of the 128 bits. ``n_near`` counts
the other rows that are near (copies each), ``near_digest`` is the sum of the
first 13 hex digits of the md5 of their ids (as text, null as empty). Both are
null for documents outside the query set.

Defined cases: null, empty and wordless texts have the all-zero fingerprint;
equal texts have equal fingerprints; repeated rows and ids are ordered by
(doc_id, text), a null doc_id before all others; the last row's next row is
the first one, also in a table of one row; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.kernels import (
    LOWER, SLICE_BYTES, SPACE_WORDS, Rolling, bitmap_of, column_bytes, in_bitmap, mix, stored, words)

BITS = 128
SPARE = 2
RADIUS = 6
ASK = 50
_NO_ID = -(1 << 63)
#: Text bytes a task should hold, for the number of ranges.
RANGE_BYTES = 16 << 20
_EACH_BIT = (np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1) * 2.0 - 1).astype(np.float32)


def fingerprints(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of 16 bytes a text."""
    n = len(offsets) - 1
    starts, ends, row = words(data, offsets, SPACE_WORDS)
    if not len(starts):
        return np.zeros((n, BITS // 8), np.uint8)
    h = Rolling(LOWER[data]).of(starts, ends)
    near = np.flatnonzero(row[1:] == row[:-1])
    pair = mix(h[near] * np.uint64(0x9E3779B97F4A7C15) + h[near + 1])
    term = np.concatenate([h, pair])
    of = np.concatenate([row, row[near]])
    weight = np.concatenate([np.ones(len(h), np.float32), np.full(len(pair), 2, np.float32)])
    votes = np.zeros((n, BITS), np.float32)
    for half, salt in enumerate((0x243F6A8885A308D3, 0x13198A2E03707344)):
        bits = mix(term ^ np.uint64(salt))
        for byte in range(8):  # votes by counting byte values, not by unpacking every hash
            value = ((bits >> np.uint64(8 * byte)) & np.uint64(255)).astype(np.int64)
            counts = np.bincount(of * 256 + value, weight, n * 256).reshape(n, 256).astype(np.float32)
            at = 64 * half + 8 * byte
            votes[:, at:at + 8] = counts @ _EACH_BIT
    return np.packbits(votes > 0, axis=1)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return 1.0 - np.unpackbits(a ^ b, axis=1).sum(axis=1) / BITS


def _of_texts(texts: list[str]) -> np.ndarray:
    """Fingerprints of a list of texts, in slices of bounded bytes."""
    out, at = [np.zeros((0, BITS // 8), np.uint8)], 0
    while at < len(texts):
        to, size = at, 0
        while to < len(texts) and (to == at or size + len(texts[to]) <= SLICE_BYTES):
            size += len(texts[to])
            to += 1
        out.append(fingerprints(*column_bytes(pa.array(texts[at:to], pa.large_string()))))
        at = to
    return np.concatenate(out)


def _hex(rows: np.ndarray) -> list[str]:
    return [r.tobytes().hex() for r in rows]


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (range, ghost, doc_id, text); a range ends with its successor's ghost."""
    held: tuple | None = None  # the row before, still without its next one
    for batch in batches:
        n = batch.num_rows
        for first in range(0, n, 256):
            part = batch.slice(first, 256)
            place, ghost, ids, texts = (c.to_pylist() for c in part.columns)
            texts = [t or "" for t in texts]
            own = _of_texts(texts)
            rows = list(zip(place, ghost, ids, texts, own, strict=True))
            if held is not None:
                rows.insert(0, held)
            held = rows.pop()
            out = [(a, b) for a, b in zip(rows, [*rows[1:], held], strict=True) if not a[1] and a[0] == b[0]]
            yield _answer(out)
    # the very last row is a ghost: every range that holds documents ends with one


def _answer(pairs: list[tuple]) -> pa.RecordBatch:
    edited = []
    for (_, _, _, text, _), (_, _, _, following, _) in pairs:
        quarter = len(text) // 4
        edited.append(text[:len(text) - quarter] + following[:quarter])
    own = np.array([a[4] for a, _ in pairs], np.uint8).reshape(-1, BITS // 8)
    nxt = np.array([b[4] for _, b in pairs], np.uint8).reshape(-1, BITS // 8)
    changed = _of_texts(edited)
    return pa.RecordBatch.from_arrays([
        pa.array([a[2] for a, _ in pairs], pa.int64()), pa.array([len(a[3]) for a, _ in pairs], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
        pa.array(_hex(own), pa.string()), pa.array(_hex(changed), pa.string()),
        pa.array(likeness(own, changed), pa.float64()), pa.array(likeness(own, nxt), pa.float64())],
        ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


NEIGHBOUR_SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                    "edited_fingerprint string, near_edited double, near_next double")


def _lookup(spark: SparkSession, keys: np.ndarray, values: np.ndarray | None):
    """A column function: how many sorted keys lie at or below an id, or the equal key's value (else -1).

    The keys, one a range of documents, are broadcast.
    """
    shared = spark.sparkContext.broadcast((keys, values))

    @F.pandas_udf("long")
    def look(ids: pd.Series) -> pd.Series:
        keys, values = shared.value
        at = np.searchsorted(keys, ids.to_numpy(), side="right")
        if values is None:
            return pd.Series(at)
        hit = keys[np.maximum(at - 1, 0)] == ids.to_numpy()
        return pd.Series(np.where(hit & (at > 0), values[np.maximum(at - 1, 0)], -1))

    return look


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprint each document, its edited text and the next document's, by ascending doc_id.

    Documents are dealt once, by ranges of doc_id of about ``RANGE_BYTES``,
    a range a task; the bounds come from quantiles over all ids. The first document of each
    range also goes, as a ghost, to the end of the range before, so no task
    needs another one's rows. To the driver come the bounds and the first id
    of each range (a few bytes a range).
    """
    spark = docs.sparkSession
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    total = base.agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")).alias("b")).first()
    if not total["n"]:
        return spark.createDataFrame([], NEIGHBOUR_SCHEMA)
    n = max(1, math.ceil((total["b"] or 0) / RANGE_BYTES))
    bounds = sorted(set(base.approxQuantile("doc_id", [i / n for i in range(1, n)], 1 / (4 * n)))) if n > 1 else []
    ranged = base.withColumn("_key", F.coalesce("doc_id", F.lit(_NO_ID)))
    place = _lookup(spark, np.array(bounds, np.int64), None)
    heads = sorted((r["_place"], r["k"]) for r in ranged.select("_key", place("_key").alias("_place"))
                   .groupBy("_place").agg(F.min("_key").alias("k")).collect())
    firsts = np.array([k for _, k in heads], np.int64)  # in the order of their ranges, so of their ids
    goes = _lookup(spark, firsts, np.array([heads[i - 1][0] for i in range(len(heads))], np.int64))
    spot = lambda where, ghost: F.struct(where.alias("p"), F.lit(ghost).alias("g"))
    both = (ranged.withColumn("_place", place("_key")).withColumn("_goes", goes("_key"))
            .select("doc_id", "text", F.explode(F.when(
                F.col("_goes") >= 0, F.array(spot(F.col("_place"), False), spot(F.col("_goes"), True)))
                .otherwise(F.array(spot(F.col("_place"), False)))).alias("_at")))
    dealt = (both.select(F.col("_at.p").alias("place"), F.col("_at.g").alias("ghost"), "doc_id", "text")
             .repartitionById(n, F.col("place").cast("int"))
             .sortWithinPartitions("place", "ghost", F.asc_nulls_first("doc_id"), F.asc_nulls_first("text")))
    return dealt.mapInArrow(_neighbours, NEIGHBOUR_SCHEMA)


def _batch_fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t or "" for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_hex(_of_texts(texts)), pa.string())],
                                         ["doc_id", "fingerprint"])


def fingerprint(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of every row of (doc_id, text)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _batch_fingerprints, "doc_id long, fingerprint string")


def _occurring(keys: DataFrame):
    """A column function: whether a key may be among ``keys`` (never false for one that is)."""
    shared = keys.sparkSession.sparkContext.broadcast(bitmap_of(keys))

    @F.pandas_udf("boolean")
    def occurs(key: pd.Series) -> pd.Series:
        return pd.Series(in_bitmap(shared.value, key.to_numpy().astype(np.int64).view(np.uint64)))

    return occurs


def find_near(queries: DataFrame, entries: DataFrame, radius: int = RADIUS) -> DataFrame:
    """All pairs (fingerprint, near, distance) of a query fingerprint and an entry within ``radius`` bits.

    Both sides have a column ``fingerprint``; distinct fingerprints stand for
    all their documents, so copies need no pairs. Complete for any radius.
    """
    n_blocks = radius + SPARE
    digits = BITS // 4
    cuts = [round(i * BITS / n_blocks) for i in range(n_blocks + 1)]
    binary = F.concat(*[F.lpad(F.conv(F.substring("fingerprint", i * 8 + 1, 8), 16, 2), 32, "0")
                        for i in range(digits // 8)])

    def tables(side: DataFrame) -> DataFrame:
        rows = side.select("fingerprint").where(F.col("fingerprint").isNotNull()).distinct().withColumn("b", binary)
        blocks = [F.substring("b", lo + 1, hi - lo) for lo, hi in zip(cuts, cuts[1:], strict=False)]
        keys = [F.xxhash64(F.lit(i), *[blocks[c] for c in chosen])
                for i, chosen in enumerate(itertools.combinations(range(n_blocks), SPARE))]
        return rows.select("fingerprint", F.explode(F.array(*keys)).alias("key"))

    q = stored(tables(queries), "query-keys")
    e = tables(entries).where(_occurring(q)("key")).select(F.col("fingerprint").alias("near"), "key")
    distance = sum((F.bit_count(F.conv(F.substring("fingerprint", i * 8 + 1, 8), 16, 10).cast("long").bitwiseXOR(
        F.conv(F.substring("near", i * 8 + 1, 8), 16, 10).cast("long"))) for i in range(digits // 8)), F.lit(0))
    return (q.join(e, "key").select("fingerprint", "near", distance.alias("distance"))
            .where(F.col("distance") <= radius).distinct())


def compare_and_search(docs: DataFrame) -> DataFrame:
    """``compare_with_next``, and for each document of the query set the near ones among all rows."""
    found = stored(compare_with_next(docs), "fingerprints")
    asks = F.coalesce(F.col("doc_id") % ASK == 0, F.lit(False))
    value = F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), 1, 13),
                   16, 10).cast("decimal(20,0)")
    asked = found.where(asks)
    members = found.groupBy(F.col("fingerprint").alias("near")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(value).alias("v"))
    near = (find_near(asked, found, RADIUS).join(members, "near").groupBy("fingerprint")
            .agg(F.sum("n").alias("n"), F.sum("v").alias("v")))
    answered = asked.join(near, "fingerprint").select(
        *found.columns, (F.col("n") - 1).alias("n_near"),
        (F.col("v") - value).cast("decimal(38,0)").cast("string").alias("near_digest"))
    return answered.unionByName(found.where(~asks).select(
        "*", F.lit(None).cast("long").alias("n_near"), F.lit(None).cast("string").alias("near_digest")))
