"""Benchmark decontamination: a prefix-filtered set join of item windows with documents.

An item gives windows of ``size`` consecutive words (fewer words: one window).
Containment is full, so one token of a window is a necessary prefix: its rarest
word, by occurrences counted over all documents. A document position holding
such a word is a candidate; the word's place in the window must leave room for
the whole window inside the document (positional and length bounds), and then
every word of the window is compared. Windows with a word that no document has
are dropped before.

Words are counted in one pass over the documents, whatever the size of the
benchmark, and each window's rarest word is picked by joins in Spark. Distinct
(item, window) rows are then dealt into blocks of about ``BLOCK_WINDOWS`` by a
hash of both, so neither an item of any length nor a window of many items makes
a block larger. Blocks are broadcast (some 10 MB each); a larger benchmark takes
more passes of marking, never a larger broadcast. Documents are not shuffled
and a hot word only costs candidates in the tasks that read it.

Defined cases: null or empty text, or text without words, has no words and no
hits; items without words never match; a null item id is the empty string;
items with equal ids count once; repeated documents are judged each on its
own; an empty benchmark or table gives no hits or no rows. Input columns
named like the results are replaced. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.kernels import ALNUM_WORDS, bitmap_of, in_bitmap, runs, slices, stored, without, word_hashes
from ledgerlake.session import checkpoint_root

BLOCK_WINDOWS = 100_000
#: Words of documents that a task counts before it hands their counts on.
HELD_WORDS = 1 << 20
RESULTS = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated", "hit_bits", "items")


def _windows_of(size: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in slices(batch, "text"):
                h, row = word_hashes(data, offsets, ALNUM_WORDS)
                at = runs(row, rows.num_rows)
                ids, packed = [], []
                for i, item in enumerate(rows.column(0).to_pylist()):
                    own = h[at[i]:at[i + 1]]
                    for j in range(max(len(own) - size, 0) + 1 if len(own) else 0):
                        ids.append(item)
                        packed.append(own[j:j + size].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.string()), pa.array(packed, pa.binary())], ["item_id", "words"])
    return find


class _Table:
    """Look up hashes in a sorted table, most misses answered by a bitmap."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.unique(keys)
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(self.keys >> np.uint64(44)).astype(np.int64)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions in h, indexes of keys) of the hashes that are keys."""
        if not len(self.keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        maybe = np.flatnonzero(self.seen[(h >> np.uint64(44)).astype(np.int64)])
        at = np.searchsorted(self.keys, h[maybe])
        at[at == len(self.keys)] = 0
        ok = self.keys[at] == h[maybe]
        return maybe[ok], at[ok]


def _words_of_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packed = [bytes(w) for w in batch.column(0).to_pylist()]
        n = np.array([len(w) // 8 for w in packed], np.int64)
        first = np.cumsum(n) - n
        yield pa.RecordBatch.from_arrays(
            [pa.array([w for w, k in zip(packed, n, strict=True) for _ in range(k)], pa.binary()),
             pa.array(np.arange(int(n.sum())) - np.repeat(first, n)),
             pa.array(np.frombuffer(b"".join(packed), np.int64))], ["words", "place", "word"])


def _count_words(bits):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for _, data, offsets in slices(batch, "text"):
                h = word_hashes(data, offsets, ALNUM_WORDS)[0]
                held.append(h[in_bitmap(bits.value, h)])
                size += len(held[-1])
                if size > HELD_WORDS:
                    yield _tally(held)
                    held, size = [], 0
        if size:
            yield _tally(held)
    return count


def _tally(held: list[np.ndarray]) -> pa.RecordBatch:
    word, n = np.unique(np.concatenate(held), return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n)], ["word", "n"])


def _by_rarest(found: DataFrame, docs: DataFrame) -> DataFrame:
    """Distinct (item_id, words) with the place of the window's rarest word in the documents."""
    windows = found.select("words").distinct().mapInArrow(_words_of_windows, "words binary, place long, word long")
    bits = docs.sparkSession.sparkContext.broadcast(bitmap_of(windows.select(F.col("word").alias("key"))))
    counts = docs.select("text").mapInArrow(_count_words(bits), "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    rarest = (windows.join(counts, "word", "left").groupBy("words")
              .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "place")).alias("least"))
              .where(F.col("least.n") > 0).select("words", F.col("least.place").alias("place")))
    return found.join(rarest, "words").select("item_id", "words", "place")


class _Windows:
    """The windows of one block, by their rarest word."""

    def __init__(self, items: list[str], packed: list[bytes], places: list[int], size: int):
        by_words: dict[bytes, set[str]] = {}
        place_of = dict(zip(packed, places, strict=True))
        for item, w in zip(items, packed, strict=True):
            by_words.setdefault(w, set()).add(item)
        self.length = np.array([len(w) // 8 for w in by_words], np.int64)
        self.words = np.zeros((len(by_words), size), np.uint64)
        for i, w in enumerate(by_words):
            self.words[i, :len(w) // 8] = np.frombuffer(w, np.uint64)
        self.items = [sorted(v) for v in by_words.values()]
        self.place = np.array([place_of[w] for w in by_words], np.int64)
        rare = self.words[np.arange(len(self.words)), self.place]
        self.by_rare = np.argsort(rare, kind="stable")
        self.table = _Table(rare)
        self.first = np.searchsorted(rare[self.by_rare], self.table.keys, side="left")
        self.n = np.searchsorted(rare[self.by_rare], self.table.keys, side="right") - self.first

    def occurrences(self, h: np.ndarray, row: np.ndarray, at: np.ndarray
                    ) -> tuple[np.ndarray, np.ndarray]:
        """(start, window) of every occurrence of a window."""
        pos, key = self.table.find(h)
        many = self.n[key]
        pos = np.repeat(pos, many)
        nth = np.arange(len(pos)) - np.repeat(np.cumsum(many) - many, many)
        window = self.by_rare[np.repeat(self.first[key], many) + nth]
        start = pos - self.place[window]
        length = self.length[window]
        fits = (start >= at[row[pos]]) & (start + length <= at[row[pos] + 1])
        start, window, length = start[fits], window[fits], length[fits]
        for j in range(self.words.shape[1]):
            same = (j >= length) | (h[np.minimum(start + j, len(h) - 1)] == self.words[window, j])
            start, window, length = start[same], window[same], length[same]
        return start, window


def _mark(windows, first: bool, keep: list[str]):
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w: _Windows = windows.value
        for batch in batches:
            for rows, data, offsets in slices(batch, "text"):
                h, row = word_hashes(data, offsets, ALNUM_WORDS)
                n_rows = rows.num_rows
                at = runs(row, n_rows)
                start, window = w.occurrences(h, row, at) if len(w.length) else ([], [])
                change = np.zeros(len(h) + 1, np.int64)
                np.add.at(change, start, 1)
                if len(start):
                    np.add.at(change, start + w.length[window], -1)
                hit = np.cumsum(change[:-1]) > 0
                names: list[set] = [set() for _ in range(n_rows)]
                pairs = np.unique(np.stack([row[start], window]), axis=1) if len(start) else [[], []]
                for r, x in zip(*pairs, strict=True):
                    names[r].update(w.items[x])
                old = [None if first else rows.column(rows.schema.get_field_index(c)).to_pylist()
                       for c in ("hit_bits", "items")]
                bits, n_hit = [], []
                for i in range(n_rows):
                    own = hit[at[i]:at[i + 1]]
                    if not first:
                        own = own | np.unpackbits(np.frombuffer(old[0][i], np.uint8), count=len(own)).astype(bool)
                        names[i].update(old[1][i])
                    bits.append(np.packbits(own).tobytes())
                    n_hit.append(int(own.sum()))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(rows.schema.get_field_index(c)) for c in keep]
                    + [pa.array(np.diff(at)), pa.array(n_hit, pa.int64()), pa.array(bits, pa.binary()),
                       pa.array([sorted(x) for x in names], pa.list_(pa.string()))],
                    [*keep, "n_words", "n_hit", "hit_bits", "items"])
    return mark


def find_contamination(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """All columns of ``docs`` plus n_words, n_hit, n_items, items_sha256, contaminated, hit_bits, items.

    ``hit_bits`` has one bit a word, first word first. ``benchmark`` has
    item_id and text.
    """
    spark = docs.sparkSession
    sc = spark.sparkContext
    docs = without(docs, *RESULTS)
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")
    windows_of = items.mapInArrow(_windows_of(size), "item_id string, words binary").distinct()
    found = stored(_by_rarest(stored(windows_of, "windows"), docs), "rarest")
    n_blocks = max(1, math.ceil(found.count() / BLOCK_WINDOWS))
    kept = docs.columns
    schema = T.StructType(docs.schema.fields + [
        T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
        T.StructField("hit_bits", T.BinaryType()), T.StructField("items", T.ArrayType(T.StringType()))])
    marked = docs
    for b in range(n_blocks):
        block = found.where(F.pmod(F.xxhash64("item_id", "words"), F.lit(n_blocks)) == b).collect()
        windows = _Windows([r["item_id"] for r in block], [bytes(r["words"]) for r in block],
                           [r["place"] for r in block], size)
        marked = marked.mapInArrow(_mark(sc.broadcast(windows), b == 0, kept), schema)
        if b % 4 == 3:  # a stage holds four blocks at most
            if not sc.getCheckpointDir():
                sc.setCheckpointDir(checkpoint_root(spark))
            marked = marked.checkpoint()
    return (marked.withColumn("n_items", F.size("items").cast("long"))
            .withColumn("items_sha256", F.sha2(F.array_join(F.array_sort("items"), ","), 256))
            .withColumn("contaminated", F.col("n_hit") > 0))
