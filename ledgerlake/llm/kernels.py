"""Numpy routines over the bytes of an Arrow text column, and small frame helpers.

A batch of texts is one byte buffer with row offsets, so words and rolling
hashes are found for all rows at once, without a Python string per row.
Batches are worked through in slices of bounded bytes (one row at least), so
memory follows the slice and the longest text, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.session import work_dir

SLICE_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}

# ASCII capitals become small letters, every other byte stays.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_class(*separators: tuple[int, int]) -> np.ndarray:
    """A table of 256 flags that is false on the given inclusive byte ranges."""
    table = np.ones(256, dtype=bool)
    for lo, hi in separators:
        table[lo:hi + 1] = False
    return table


#: Words between white space: `[^\x20\x09-\x0D]+`.
SPACE_WORDS = byte_class((0x20, 0x20), (0x09, 0x0D))
#: Words of ASCII letters, digits and everything beyond ASCII: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`
#: after lower-casing, hence capitals count as letters.
ALNUM_WORDS = byte_class((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))


def column_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes and its n + 1 row offsets; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("" if pa.types.is_string(texts.type)
                                or pa.types.is_large_string(texts.type) else b"")
    n = len(texts)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32,
                            count=texts.offset + n + 1)[texts.offset:].astype(np.int64)
    data = texts.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES
           ) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut a batch into runs of rows of about ``limit`` bytes: (rows, bytes, offsets)."""
    data, offsets = column_bytes(batch.column(batch.schema.get_field_index(column)))
    at, n = 0, batch.num_rows
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        to = min(max(to, at + 1), n)
        yield (batch.slice(at, to - at), data[offsets[at]:offsets[to]],
               offsets[at:to + 1] - offsets[at])
        at = to


def _power(name: str, base: int, n: int) -> np.ndarray:
    """base**0 .. base**n modulo 2**64, kept and grown per Python worker."""
    have = _powers.get(name)
    if have is None or len(have) <= n:
        size = max(n + 1, SLICE_BYTES + 1)
        grown = np.full(size, base, np.uint64)
        grown[0] = 1
        have = np.multiply.accumulate(grown)
        _powers[name] = have
        if size > 8 * SLICE_BYTES:  # one very long text: do not keep its tables
            del _powers[name]
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over all output bits (a bijection on 64 bits)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Rolling:
    """Hashes of any substrings of one byte buffer, from prefix sums modulo 2**64."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.inverse = _power("inverse", _INVERSE, n)
        terms = (data.astype(np.uint64) + np.uint64(1)) * _power("base", _BASE, n)[:n]
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(terms, out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each ``data[start:end]``, the length included."""
        h = (self.sums[ends] - self.sums[starts]) * self.inverse[starts]
        return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def grams(self, k: int, first: int, n: int) -> np.ndarray:
        """The hashes of the n strings of k bytes that start at ``first`` and behind it."""
        h = self.sums[first + k:first + k + n] - self.sums[first:first + n]
        h *= self.inverse[first:first + n]
        h += np.uint64(k * 0xD6E8FEB86659FD93 % (1 << 64))
        return mix(h)


def words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every word; words never cross rows."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = is_word[data]
    edge = np.zeros(n + 1, bool)  # a row ends and another one starts here
    edge[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:n]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(offsets, starts, side="right") - 1


def word_hashes(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray
                ) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every word after lower-casing A-Z."""
    starts, ends, row = words(data, offsets, is_word)
    if len(starts) == 0:
        return np.zeros(0, np.uint64), row
    return Rolling(LOWER[data]).of(starts, ends), row


def runs(row: np.ndarray, n_rows: int) -> np.ndarray:
    """n_rows + 1 offsets of each row's run in a sorted row index."""
    return np.searchsorted(row, np.arange(n_rows + 1))


def sequence_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive hashes; entry i covers i .. i+k-1."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    n = len(h) - k + 1
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * np.uint64(_BASE) + h[j:j + n]
    return mix(out)


#: Rows of an Arrow batch; whole documents are a few kB each, some a hundred times that.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Have Spark hand whole texts to Python in batches of some MB instead of some 30 MB.

    A batch exists in the JVM and in the Python worker at once; the setting
    is only ever lowered.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that the frame does not have."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop input columns whose names an operator's results take."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


#: Bits of a bitmap of keys, and of one row of it (fixed by Spark's bitmap functions).
KEY_BITS = 24
BUCKET_BITS = 15


def bitmap_of(keys: DataFrame) -> np.ndarray:
    """The bitmap of the leading bits of the 64-bit hashes ``key``: 2 MB, whatever their number."""
    place = F.shiftrightunsigned("key", 64 - KEY_BITS)
    buckets = (keys.select(F.shiftright(place, BUCKET_BITS).alias("bucket"),
                           place.bitwiseAND(F.lit((1 << BUCKET_BITS) - 1)).alias("bit"))
               .groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")))
    bits = np.zeros((1 << (KEY_BITS - BUCKET_BITS), 1 << (BUCKET_BITS - 3)), np.uint8)
    for r in buckets.collect():
        bits[r["bucket"]] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return bits.reshape(-1)


def in_bitmap(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether each hash may be among the bitmap's keys (never false for one that is)."""
    at = (h >> np.uint64(64 - KEY_BITS)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back.

    It cuts lineage with files that outlive any executor; they are deleted
    when the application ends, until when results may be read from them.
    """
    spark: SparkSession = df.sparkSession
    path = work_dir(spark, name)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
