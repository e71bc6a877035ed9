"""Periodic runs of words, found through string synchronising sets.

A run is a stretch of consecutive words with smallest period q, at least
``max(min_length, EXPONENT * q)`` words long, that no neighbouring word
extends. All texts of a slice are one sequence of word hashes with a unique
separator behind each text, so no run crosses texts.

For the scales t = 4, 8, 16, ... (periods t <= q < 2t):

1. Every stretch of t words has a hash. The synchronising set of the scale
   holds the positions i where the least hash of the stretches at i .. i+t is
   that of i or of i+t; stretches of period t/4 or less do not compete. So
   whether i belongs to it depends on the 2t words behind i alone, and every
   3t words hold a member unless they have a period of t/4 or less.
2. Members with equal contexts (2t words) one behind the other propose their
   distance as a period, if it is one of the scale. Inside a run of period q
   the next member of equal context is exactly q further: contexts overlap by
   more than a period, and a shorter distance would make q no smallest period.
3. Proposals of one period that overlap by a period or more are one stretch;
   it is extended by words compared one by one. Members are at most t apart
   inside a run, so less than 2t words are left on either side.

Periods below 4, and with them the highly periodic stretches that step 1
leaves out at the first scale, come from comparing each word with those 1, 2
and 3 further. Stretches that a later scale leaves out have a period of t/4
or less and are runs of an earlier scale.

Per scale the work is linear, and only texts long enough for it take part.
Words, stretches and contexts are told apart by 64-bit hashes.

Defined cases: null, empty and wordless texts have no run and collapse to an
empty text; texts are read whole, however long; of runs of equal length the
one of least start, then period, is the longest; repeated rows give repeated
results; an empty table gives no rows; input columns named like results are
left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.kernels import SPACE_WORDS, Rolling, mix, runs, slices, without, words

#: A run repeats its period so many times at least.
EXPONENT = 4
MIN_LENGTH = 6
FIRST_SCALE = 4
_TOP = np.uint64((1 << 64) - 1)


def _window_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values, from running minima of blocks in both directions."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, _TOP)
    padded[:len(values)] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).reshape(-1)
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])


def _short_periods(w: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """(start, end, q) of the maximal stretches of period q = 1, 2, 3 with EXPONENT * q words or more."""
    out = []
    seen = np.zeros(0, np.int64)
    for q in range(1, FIRST_SCALE):
        if len(w) <= q:
            break
        equal = np.zeros(len(w) - q + 2, np.int8)
        equal[1:-1] = w[:-q] == w[q:]
        turn = np.diff(equal)
        start, end = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1) + q
        long = end - start >= EXPONENT * q
        start, end = start[long], end[long]
        key = start * (len(w) + 1) + end  # the same stretch with a smaller period
        new = ~np.isin(key, seen)
        seen = np.concatenate([seen, key[new]])
        out.append((start[new], end[new], q))
    return out


def _double(h: np.ndarray, step: int) -> np.ndarray:
    """Hashes of stretches twice as long."""
    return mix(h[:-step] * np.uint64(0x9E3779B97F4A7C15) + np.bitwise_xor(h[step:], np.uint64(0xD1B54A32D192ED03)))


def _scale(w: np.ndarray, h: np.ndarray, context: np.ndarray, t: int, periodic: np.ndarray
           ) -> list[tuple[int, int, int]]:
    """(start, end, q) of the maximal stretches with t <= q < 2t and EXPONENT * q words or more.

    ``h`` and ``context`` are hashes of t and 2t words; ``periodic`` marks the
    stretches of t words that do not compete.
    """
    value = np.where(periodic[:len(h)], _TOP, h)
    least = _window_min(value, t + 1)[:len(context)]
    here = np.arange(len(least))
    member = here[(least != _TOP) & ((least == value[:len(least)]) | (least == value[t:t + len(least)]))]
    if len(member) < 2:
        return []
    key = context[member]
    order = np.argsort(key, kind="stable")
    first, second = member[order[:-1]], member[order[1:]]
    q = second - first
    good = (key[order[:-1]] == key[order[1:]]) & (q >= t) & (q < 2 * t)
    if not good.any():
        return []
    first, q = first[good], q[good]
    order = np.lexsort((first, q))
    first, q = first[order], q[order]
    end = first + q + 2 * t  # the words first .. end have period q
    # one behind the other and overlapping by a period: the ends grow with the starts, so neighbours suffice
    new = np.ones(len(first), bool)
    new[1:] = (q[1:] != q[:-1]) | (first[1:] + q[1:] > end[:-1])
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(first)) - 1
    out = []
    for lo, hi, p in zip(first[at].tolist(), end[last].tolist(), q[at].tolist(), strict=True):
        lo, hi = _extend(w, lo, hi, p)
        if hi - lo >= EXPONENT * p:
            out.append((lo, hi, p))
    return sorted(set(out))


def _extend(w: np.ndarray, lo: int, hi: int, p: int) -> tuple[int, int]:
    """Grow a stretch of period p as far as words p apart are equal, in steps of growing size."""
    step = 64
    while hi < len(w):
        to = min(hi + step, len(w))
        same = w[hi:to] == w[hi - p:to - p]
        if not same.all():
            hi += int(same.argmin())
            break
        hi, step = to, step * 2
    step = 64
    while lo > 0:
        to = max(lo - step, 0)
        same = (w[to:lo] == w[to + p:lo + p])[::-1]
        if not same.all():
            lo -= int(same.argmin())
            break
        lo, step = to, step * 2
    return lo, hi


def find_runs(w: np.ndarray, at: np.ndarray, min_length: int = MIN_LENGTH
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, length, period) of every run, sorted; row r holds the word hashes ``at[r]:at[r + 1]``.

    Starts count from the row's first word.
    """
    n_rows = len(at) - 1
    size = np.diff(at)
    rows_here = np.arange(n_rows)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []

    def lay(keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The kept rows one behind the other with a separator behind each, and their offsets."""
        n = size[keep]
        first = np.concatenate([[0], np.cumsum(n + 1)])
        place = np.arange(int(n.sum())) + np.repeat(np.arange(len(keep)), n)
        seq = mix(np.arange(first[-1], dtype=np.uint64) ^ np.uint64(0xA0761D6478BD642F))  # separators: all different
        source = np.repeat(at[keep] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        seq[place] = w[source]
        return seq, first

    def note(keep, first, start, end, q):
        row = np.searchsorted(first, start, side="right") - 1
        found.append((keep[row], start - first[row], end - start, np.broadcast_to(q, start.shape)))

    keep = rows_here[size >= EXPONENT]
    seq, first = lay(keep)
    for start, end, q in _short_periods(seq):
        note(keep, first, start, end, q)
    t, h = 1, seq
    while True:
        if t >= FIRST_SCALE:
            long = size[keep] >= EXPONENT * t
            if not long.any():
                break
            if long.sum() * 2 <= len(long):  # go on with the long texts alone
                keep = keep[long]
                seq, first = lay(keep)
                h, k = seq, 1
                while k < t:
                    h, k = _double(h, k), 2 * k
            context = _double(h, t)
            periodic = np.zeros(len(seq) + 1, np.int32)
            back = np.full(n_rows, -1)
            back[keep] = np.arange(len(keep))
            for row, start, length, q in found:
                if len(row) and int(q.min()) * EXPONENT <= t:
                    use = (length >= t) & (q * EXPONENT <= t) & (back[row] >= 0)
                    begin = first[back[row[use]]] + start[use]
                    np.add.at(periodic, begin, 1)
                    np.add.at(periodic, begin + length[use] - t + 1, -1)
            hits = _scale(seq, h, context, t, np.cumsum(periodic) > 0)
            if hits:
                start, end, q = (np.array(c) for c in zip(*hits, strict=True))
                note(keep, first, start, end, q)
            h = context
        else:
            if len(h) <= t:
                break
            h = _double(h, t)
        t *= 2
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    row, start, length, q = (np.concatenate(c) for c in zip(*found, strict=True))
    good = length >= min_length
    order = np.lexsort((q[good], start[good], row[good]))
    return tuple(c[good][order].astype(np.int64) for c in (row, start, length, q))  # type: ignore[return-value]


def kept_words(size: np.ndarray, at: np.ndarray, row: np.ndarray, start: np.ndarray, length: np.ndarray,
               period: np.ndarray) -> np.ndarray:
    """False for each word that a run holds behind its first period."""
    cover = np.zeros(int(size.sum()) + 1, np.int32)
    np.add.at(cover, at[row] + start + period, 1)
    np.add.at(cover, at[row] + start + length, -1)
    return np.cumsum(cover[:-1]) == 0


RUN = T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                    T.StructField("period", T.LongType())])


def _slice(data: np.ndarray, offsets: np.ndarray, min_length: int) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Word counts, runs and collapsed texts of a slice's rows."""
    n_rows = len(offsets) - 1
    starts, ends, of = words(data, offsets, SPACE_WORDS)
    at = runs(of, n_rows)
    size = np.diff(at)
    h = Rolling(data).of(starts, ends) if len(starts) else np.zeros(0, np.uint64)
    row, start, length, period = find_runs(h, at, min_length)
    kept = kept_words(size, at, row, start, length, period)
    # bytes of kept words, and one blank behind each but the row's last
    first, last, of = starts[kept], ends[kept], of[kept]
    more = np.zeros(len(first), bool)
    more[:-1] = of[:-1] == of[1:]
    cover = np.zeros(len(data) + 1, np.int32)
    cover[first] += 1
    np.add.at(cover, last + more, -1)  # the white space behind a word is a byte at least
    taken = np.cumsum(cover[:-1]) > 0
    out = data.copy()
    out[last[more]] = 0x20
    n = last - first + more
    total = np.zeros(n_rows + 1, np.int64)
    np.add.at(total, of + 1, n)
    text = pa.LargeStringArray.from_buffers(n_rows, pa.py_buffer(np.cumsum(total).tobytes()), pa.py_buffer(out[taken].tobytes()))
    lists = pa.ListArray.from_arrays(
        pa.array(np.searchsorted(row, np.arange(n_rows + 1)), pa.int32()),
        pa.StructArray.from_arrays([pa.array(c) for c in (start, length, period)], ["start", "length", "period"]))
    return pa.array(size, pa.int64()), lists, text


def collapse_runs(docs: DataFrame, keep: list[str] | None = None, min_length: int = MIN_LENGTH) -> DataFrame:
    """The kept columns (all but ``text`` by default), and for each row of ``text``:

    n_words; runs (start, length, period in words, sorted by start, then
    period); collapsed (the words outside all runs and the first period of
    each, joined by one blank). One pass without a shuffle.
    """
    names = ["n_words", "runs", "collapsed"]
    kept = without(docs if keep is None else docs.select(*keep), "text", *names)
    source = docs.select(*[docs[c] for c in kept.columns], docs["text"].alias("_text_"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in slices(batch, "_text_"):
                size, lists, text = _slice(data, offsets, min_length)
                yield pa.RecordBatch.from_arrays([*rows.columns[:-1], size, lists, text.cast(pa.string())],
                                                 [*rows.schema.names[:-1], *names])

    return source.mapInArrow(run, T.StructType([
        *kept.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)),
        T.StructField("collapsed", T.StringType())]))


def longest(found: Column) -> Column:
    """The run of greatest length, then least start, then least period; null without runs."""
    key = F.transform(found, lambda r: F.struct((-r["length"]).alias("n"), r["start"].alias("start"),
                                                r["period"].alias("period")))
    best = F.array_min(key)
    return F.when(F.size(found) > 0, F.struct(best["start"].alias("start"), (-best["n"]).alias("length"),
                                              best["period"].alias("period")))
