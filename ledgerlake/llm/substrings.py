"""Suffix-array dedup: byte strings of a given length that also start in an earlier document are cut.

The suffix arrays are built in many tasks, over just the text that can repeat:

1. Every window of ``length`` bytes has one *anchor*, the leftmost smallest
   hash among its ``GRAM``-byte strings, so equal windows have equal anchors.
   Documents are dealt once into blocks of bounded bytes (this shuffle serves
   three steps). A block sends each distinct anchor with the number of its
   documents, packed by hash range.
2. A hash range returns to each block its anchors that occur in two or more
   documents.
3. A block cuts the *fragments* of these anchors (an anchor's windows are
   neighbours: one stretch of bytes) and sends each distinct fragment once,
   with its smallest and largest document id, to the anchor's range. An anchor
   in more than ``HOT`` documents sends its windows one by one, to the ranges
   of their own hashes, so no anchor makes a large group.
4. A range joins equal fragments and sorts their suffixes in two stages: those
   smaller than their successor directly, all others induced from these by one
   scan over the buckets of first bytes. Neighbours in the array with a common
   prefix of ``length`` bytes or more are equal windows; the smallest document
   of each such group returns to the blocks as runs of windows.
5. A block removes the bytes of its windows that start in an earlier document.

Anchors and fragments are told apart by 54 or more bits of hash and by 64 bits; windows
are compared as bytes.

Defined cases: null text is empty; texts below ``length`` bytes lose nothing;
a null doc_id is the smallest id and shown as null; rows of equal id do not cut
each other; very long texts are worked in pieces; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.kernels import Rolling, mix, slices

GRAM = 20
#: Text bytes of a block, and of what a hash range serves.
BLOCK_BYTES = 16 << 20
#: Documents of an anchor from which on its windows go one by one (some 2 MB of fragments, SORT_BYTES).
HOT = 30_000
SORT_BYTES = 2 << 20
_PLACE = np.uint64(28)  # bits for a position; the other 36 order the hashes
_PIECE = 1 << 27
_NO_ID = -(1 << 63)
_LAST = np.iinfo(np.int64).max


def _pack(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a).tobytes())


def _unpack(raw: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), kind)


def _six(keys: np.ndarray, bits: int) -> bytes:
    """The 48 bits below the range's own ``bits`` of each key."""
    return (keys << np.uint64(bits) >> np.uint64(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _from_six(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view("<u8").reshape(-1)


def anchors(data: np.ndarray, offsets: np.ndarray, length: int
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, Rolling]:
    """Runs of windows with one anchor: (first window, last window, row, anchor hash), and the hashes."""
    roll = Rolling(data)
    n = len(data)
    parts = []
    for at in range(0, max(n - length + 1, 0), _PIECE):
        to = min(n, at + _PIECE + length - 1)  # windows at .. at + _PIECE - 1
        places = np.arange(to - at - GRAM + 1, dtype=np.uint64)
        value = (roll.grams(GRAM, at, len(places)) >> _PLACE << _PLACE) | places
        span, width = length - GRAM + 1, 1
        least = value
        while width * 2 <= span:
            least = np.minimum(least[:len(least) - width], least[width:])
            width *= 2
        if width < span:
            least = np.minimum(least[:len(least) - (span - width)], least[span - width:])
        parts.append((least & ((np.uint64(1) << _PLACE) - np.uint64(1))).astype(np.int64) + at)
    if not parts:
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64), roll
    anchor = np.concatenate(parts)
    valid = np.zeros(n + 1, np.int64)  # windows that lie inside one row
    size = np.diff(offsets)
    some = size >= length
    np.add.at(valid, offsets[:-1][some], 1)
    np.add.at(valid, offsets[1:][some] - length + 1, -1)
    inside = np.cumsum(valid)[:len(anchor)] > 0
    first = inside.copy()
    first[1:] &= (anchor[1:] != anchor[:-1]) | ~inside[:-1]
    last = inside.copy()
    last[:-1] &= (anchor[1:] != anchor[:-1]) | ~inside[1:]
    a, b = np.flatnonzero(first), np.flatnonzero(last)
    row = np.searchsorted(offsets, a, side="right") - 1
    # anchors have small hashes: mix again, so that their ranges fill evenly
    return a, b, row, mix(roll.of(anchor[a], anchor[a] + GRAM) ^ np.uint64(0xA4093822299F31D0)), roll


def suffix_order(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """All suffixes in order of their first ``depth`` bytes at least, and their 8-byte words.

    Stage one sorts the suffixes smaller than their successors; stage two
    induces the others, bucket by bucket, from the suffixes before them.
    """
    n = len(text)
    padded = np.zeros(n + depth + 16, np.uint64)
    padded[:n] = text
    word = np.zeros(n + depth + 8, np.uint64)
    for i in range(8):
        word = (word << np.uint64(8)) | padded[i:i + len(word)]
    # the next place where the byte changes decides; the end counts as smaller than any byte
    change = np.flatnonzero(text[1:] != text[:-1])
    small = np.zeros(n, bool)
    if len(change):
        small[:change[-1] + 1] = np.repeat(text[change] < text[change + 1], np.diff(change, prepend=-1))

    # stage one: refine by eight bytes at a time, only where suffixes still tie
    direct = np.flatnonzero(small)
    direct = direct[np.argsort(word[direct], kind="stable")]
    group = np.cumsum(np.concatenate([[0], word[direct][1:] != word[direct][:-1]])) if len(direct) else direct
    open_ = np.arange(len(direct))
    for step in range(8, depth, 8):
        g = group[open_]
        tied = np.zeros(len(open_), bool)
        tied[1:] |= g[1:] == g[:-1]
        tied[:-1] |= g[1:] == g[:-1]
        open_ = open_[tied]
        if not len(open_):
            break
        g, w = group[open_], word[direct[open_] + step]
        order = np.lexsort((w, g))
        direct[open_] = direct[open_][order]
        w = w[order]
        new = np.concatenate([[0], np.cumsum((g[1:] != g[:-1]) | (w[1:] != w[:-1]))])
        # group numbers need only be distinct and in order within the open part
        group[open_] = new + np.int64(1) * len(direct) * (step // 8)

    # stage two
    starts = np.searchsorted(text[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    if n:
        waiting[text[n - 1]].append(np.array([n - 1]))
    out = []
    for c in range(256):
        induced = []
        level = np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, np.int64)
        while len(level):
            induced.append(level)
            before = level[level > 0] - 1
            level = before[text[before] == c]
        bucket = np.concatenate([*induced, direct[starts[c]:starts[c + 1]]])
        waiting[c] = []
        if not len(bucket):
            continue
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        char = text[before]
        before, char = before[char > c], char[char > c]
        order = np.argsort(char, kind="stable")
        before, char = before[order], char[order]
        cut = np.flatnonzero(np.diff(char)) + 1
        for part in np.split(before, cut):
            if len(part):
                waiting[text[part[0]]].append(part)
    return (np.concatenate(out) if out else np.zeros(0, np.int64)), word


def first_documents(text: np.ndarray, window: np.ndarray, doc: np.ndarray, length: int) -> np.ndarray:
    """For each window start the smallest ``doc`` among the windows with equal bytes."""
    order, word = suffix_order(text, length)
    still = np.arange(len(order) - 1)  # neighbours whose common prefix may reach ``length``
    for step in range(0, length, 8):
        a, b = word[order[still] + step], word[order[still + 1] + step]
        if step + 8 > length:
            a, b = (w >> np.uint64(8 * (step + 8 - length)) for w in (a, b))
        still = still[a == b]
    head = np.ones(len(order), bool)
    head[still + 1] = False
    heads = np.flatnonzero(head)
    own = np.full(len(text), _LAST)
    own[window] = doc
    least = np.minimum.reduceat(own[order], heads)
    rank = np.zeros(len(text), np.int64)
    rank[order] = np.repeat(np.arange(len(heads)), np.diff(np.concatenate([heads, [len(order)]])))
    return least[rank[window]]


def _gather(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of all stretches, one after the other; indexes are made for about a megabyte at a time."""
    ends = np.cumsum(size)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    i = 0
    while i < len(size):
        first = int(ends[i] - size[i])
        j = max(int(np.searchsorted(ends, first + (1 << 20), side="right")), i + 1)
        n, at = size[i:j], ends[i:j] - size[i:j] - first
        out[first:int(ends[j - 1])] = data[np.repeat(start[i:j] - at, n) + np.arange(int(ends[j - 1]) - first)]
        i = j
    return out


def _by_range(keys: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """Runs of equal leading bits in sorted keys."""
    part = (keys >> np.uint64(64 - bits)).astype(np.int64)
    cut = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(part)]])
    for a, b in zip(cut[:-1], cut[1:], strict=True):
        if b > a:
            yield int(part[a]), slice(a, b)


def _documents(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, bytes, offsets) in slices of a block's rows."""
    for batch in table.combine_chunks().to_batches():
        for rows, data, offsets in slices(batch, "text", 1 << 20):
            yield rows.column(rows.schema.get_field_index("doc_id")).to_numpy(), data, offsets


def _send_anchors(length: int, bits: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        keys, ids = [], []
        for doc, data, offsets in _documents(table):
            _, _, row, k, _ = anchors(data, offsets, length)
            # one entry a document and anchor
            order = np.lexsort((doc[row], k))
            k, d = k[order], doc[row][order]
            new = np.ones(len(k), bool)
            new[1:] = (k[1:] != k[:-1]) | (d[1:] != d[:-1])
            keys.append(k[new])
            ids.append(d[new])
        k, d = np.concatenate(keys or [np.zeros(0, np.uint64)]), np.concatenate(ids or [np.zeros(0, np.int64)])
        order = np.lexsort((d, k))
        k, d = k[order], d[order]
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1]) | (d[1:] != d[:-1])
        unique, n = np.unique(k[new], return_counts=True)
        n = np.minimum(n, 65535).astype(np.uint16)
        rows = [(p, _six(unique[s], bits), _pack(n[s])) for p, s in _by_range(unique, bits)]
        return pa.table({"part": pa.array([r[0] for r in rows], pa.int64()),
                         "block": pa.array([key[0].as_py()] * len(rows), pa.int64()),
                         "keys": pa.array([r[1] for r in rows], pa.binary()),
                         "counts": pa.array([r[2] for r in rows], pa.binary())})
    return run


def _shared(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Of each block's anchors in this range, those in two or more documents; a flag for hot ones."""
    blocks = table.column("block").to_pylist()
    keys = [_from_six(x) for x in table.column("keys").to_pylist()]
    counts = [_unpack(x, np.uint16) for x in table.column("counts").to_pylist()]
    size = [len(k) for k in keys]
    unique, of = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(of, np.concatenate(counts).astype(np.float64))
    out, at = [], 0
    for block, k, n in zip(blocks, keys, size, strict=True):
        t = total[of[at:at + n]]
        at += n
        keep = t >= 2
        if keep.any():
            out.append((block, (k[keep] << np.uint64(0)).tobytes(), _pack(t[keep] > HOT)))
    six = [np.frombuffer(k, "<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes() for _, k, _ in out]
    return pa.table({"block": pa.array([r[0] for r in out], pa.int64()),
                     "part": pa.array([key[0].as_py()] * len(out), pa.int64()),
                     "keys": pa.array(six, pa.binary()), "hot": pa.array([r[2] for r in out], pa.binary())})


def _wanted(table: pa.Table, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A block's shared anchors (leading bits + 48) in order, and which are hot."""
    parts = table.column("part").to_pylist()
    order = np.argsort(np.array(parts, np.int64), kind="stable")
    keys, hot = table.column("keys").to_pylist(), table.column("hot").to_pylist()
    k = [(np.uint64(parts[i]) << np.uint64(64 - bits)) | (_from_six(keys[i]) << np.uint64(16) >> np.uint64(bits))
         for i in order]
    h = [_unpack(hot[i], bool) for i in order]
    none = [np.zeros(0, np.uint64)], [np.zeros(0, bool)]
    return np.concatenate(k or none[0]), np.concatenate(h or none[1])


def _known(k: np.ndarray, keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Which full hashes are among the keys (their leading bits + 48), and where."""
    cut = np.uint64(16 - bits) if bits < 16 else np.uint64(0)
    k = k >> cut << cut
    at = np.searchsorted(keys, k)
    at[at == len(keys)] = 0
    return (keys[at] == k) if len(keys) else np.zeros(len(k), bool), at


def _windows(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every window of the runs, and its run."""
    n = b - a + 1
    run = np.repeat(np.arange(len(a)), n)
    return np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + a[run], run


def _send_fragments(length: int, bits: int):
    def run(key: tuple[pa.Scalar, ...], docs: pa.Table, answers: pa.Table) -> pa.Table:
        keys, hot = _wanted(answers, bits)
        got: list[tuple] = []  # group key, fragment hash, hot anchor, smallest and largest id, size, bytes
        for doc, data, offsets in _documents(docs):
            a, b, row, k, roll = anchors(data, offsets, length)
            known, at = _known(k, keys, bits)
            a, b, row, k, at = a[known], b[known], row[known], k[known], at[known]
            warm = hot[at] if len(hot) else np.zeros(len(a), bool)
            w, run_of = _windows(a[warm], b[warm])
            start = np.concatenate([a[~warm], w])
            end = np.concatenate([b[~warm], w]) + length
            h = roll.of(start, end)
            g = np.concatenate([k[~warm], h[len(a) - int(warm.sum()):]])
            via = np.concatenate([np.zeros(int((~warm).sum()), np.uint64), k[warm][run_of]])
            d = doc[np.concatenate([row[~warm], row[warm][run_of]])]
            got.append(_distinct(h, g, via, d, d, start, end - start, data))
        if not got:
            return _FRAGMENTS.empty_table()
        data = np.concatenate([x[7] for x in got])
        size = np.concatenate([x[6] for x in got])
        h, g, via, lo, hi = (np.concatenate([x[i] for x in got]) for i in range(5))
        h, g, via, lo, hi, _, size, data = _distinct(h, g, via, lo, hi, np.cumsum(size) - size, size, data)
        rows, ends = [], np.concatenate([[0], np.cumsum(size)])
        for p, s in _by_range(g, bits):
            rows.append((p, _six(g[s], bits), h[s].tobytes(), _pack(via[s]), _pack(lo[s]), _pack(hi[s]),
                         _pack(size[s].astype(np.uint32)), _pack(data[ends[s.start]:ends[s.stop]])))
        return pa.table({"part": [r[0] for r in rows], "block": [key[0].as_py()] * len(rows),
                         **{name: [r[i + 1] for r in rows] for i, name in enumerate(_FRAGMENT_COLUMNS)}},
                        schema=_FRAGMENTS)
    return run


_FRAGMENT_COLUMNS = ("g", "h", "via", "lo", "hi", "size", "data")
_FRAGMENTS = pa.schema([("part", pa.int64()), ("block", pa.int64())] + [(c, pa.binary()) for c in _FRAGMENT_COLUMNS])


def _distinct(h, g, via, lo, hi, start, size, data):
    """One entry a fragment hash, ordered by group key: least and greatest ids, its bytes gathered."""
    order = np.lexsort((lo, h, g))
    new = np.ones(len(order), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (g[order][1:] != g[order][:-1])
    heads = np.flatnonzero(new)
    one = order[heads]
    top = np.maximum.reduceat(hi[order], heads) if len(heads) else hi
    return h[one], g[one], via[one], lo[one], top, start[one], size[one], _gather(data, start[one], size[one])


def _match(length: int):
    """Sort the range's fragments; return each window's first document where it precedes a block's last."""
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        n_rows = table.num_rows
        column = {c: table.column(c).to_pylist() for c in _FRAGMENT_COLUMNS}
        g = np.concatenate([_from_six(x) for x in column["g"]])
        h = np.concatenate([np.frombuffer(x, np.uint64) for x in column["h"]])
        via = np.concatenate([_unpack(x, np.uint64) for x in column["via"]])
        lo, hi = (np.concatenate([_unpack(x, np.int64) for x in column[c]]) for c in ("lo", "hi"))
        sizes = [_unpack(x, np.uint32).astype(np.int64) for x in column["size"]]
        block = np.repeat(np.arange(n_rows), [len(s) for s in sizes])
        size = np.concatenate(sizes)
        data = np.concatenate([_unpack(x, np.uint8) for x in column["data"]])
        start = np.cumsum(size) - size
        order = np.lexsort((lo, h, g))
        new = np.ones(len(order), bool)
        new[1:] = (h[order][1:] != h[order][:-1]) | (g[order][1:] != g[order][:-1])
        heads = np.flatnonzero(new)
        one = order[heads]  # the distinct fragments, each with its smallest document
        which = np.zeros(len(order), np.int64)
        which[order] = np.cumsum(new) - 1
        runs = []
        ends = np.cumsum(size[one])
        at = 0
        while at < len(one):
            to = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SORT_BYTES, side="right"))
            to = min(max(to, at + 1), len(one))
            while to < len(one) and g[one[to]] == g[one[to - 1]]:  # equal windows have equal group keys
                to += 1
            own = one[at:to]
            text = _gather(data, start[own], size[own])
            first = np.cumsum(size[own]) - size[own]
            w, of = _windows(first, first + size[own] - length)
            least = first_documents(text, w, lo[own][of], length)
            cut = np.ones(len(w), bool)
            cut[1:] = (of[1:] != of[:-1]) | (least[1:] != least[:-1])
            c = np.flatnonzero(cut)
            runs.append((of[c] + at, w[c] - first[of[c]], np.diff(np.concatenate([c, [len(w)]])), least[c]))
            at = to
        frag, off, long, least = (np.concatenate([r[i] for r in runs]) for i in range(4))
        per = np.searchsorted(frag, np.arange(len(one) + 1))
        # to every block that sent the fragment, the runs that precede its last document
        many = per[which + 1] - per[which]
        entry = np.repeat(np.arange(len(which)), many)
        r = np.repeat(per[which] - np.cumsum(many) + many, many) + np.arange(int(many.sum()))
        keep = least[r] < hi[entry]
        entry, r = entry[keep], r[keep]
        cuts = np.searchsorted(block[entry], np.arange(n_rows + 1))  # entries are in the rows' order
        blocks = table.column("block").to_pylist()
        out = []
        for i in range(n_rows):
            s = slice(cuts[i], cuts[i + 1])
            if s.stop > s.start:
                e, x = entry[s], r[s]
                out.append((blocks[i], h[e].tobytes(), _pack(via[e]), _pack(off[x].astype(np.uint32)),
                            _pack(long[x].astype(np.uint32)), _pack(least[x])))
        names = ["block", "h", "via", "off", "long", "least"]
        return pa.table({c: pa.array([o[i] for o in out], pa.int64() if i == 0 else pa.binary())
                         for i, c in enumerate(names)})
    return run


_RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                     ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])


def _remove(length: int, with_kept: bool):
    def run(key: tuple[pa.Scalar, ...], docs: pa.Table, answers: pa.Table) -> pa.Table:
        kinds = {"h": np.uint64, "via": np.uint64, "off": np.uint32, "long": np.uint32, "least": np.int64}
        got = {c: [np.frombuffer(x, k) if c == "h" else _unpack(x, k) for x in answers.column(c).to_pylist()]
               for c, k in kinds.items()}
        got = {c: np.concatenate(v) if v else np.zeros(0, kinds[c]) for c, v in got.items()}
        order = np.argsort(got["h"], kind="stable")
        got = {c: v[order] for c, v in got.items()}
        hot = np.unique(got["via"][got["via"] != 0])
        out = []
        for doc, data, offsets in _documents(docs):
            a, b, row, k, roll = anchors(data, offsets, length)
            warm = np.isin(k, hot) if len(hot) else np.zeros(len(k), bool)
            w, of = _windows(a[warm], b[warm])
            start = np.concatenate([a[~warm], w])
            end = np.concatenate([b[~warm], w]) + length
            own = doc[np.concatenate([row[~warm], row[warm][of]])]
            h = roll.of(start, end)
            lo, hi = (np.searchsorted(got["h"], h, side=s) for s in ("left", "right"))
            many = hi - lo
            run_of = np.repeat(np.arange(len(h)), many)
            r = np.repeat(lo - np.cumsum(many) + many, many) + np.arange(int(many.sum()))
            gone = got["least"][r] < own[run_of]
            run_of, r = run_of[gone], r[gone]
            first = start[run_of] + got["off"][r]
            change = np.zeros(len(data) + 1, np.int64)
            np.add.at(change, first, 1)
            np.add.at(change, first + got["long"][r].astype(np.int64) - 1 + length, -1)
            removed = np.cumsum(change[:-1]) > 0
            head = removed.copy()
            head[1:] &= ~removed[:-1]
            # a removed run that reaches a row's end goes on as a new one in the next row
            border = offsets[1:-1][offsets[1:-1] < len(data)]
            head[border] |= removed[border]
            total = np.concatenate([[0], np.cumsum(removed)])
            spans = np.concatenate([[0], np.cumsum(head)])
            for i in range(len(doc)):
                s = slice(offsets[i], offsets[i + 1])
                kept = data[s][~removed[s]].tobytes()
                out.append((None if doc[i] == _NO_ID else int(doc[i]), int(s.stop - s.start),
                            int(total[s.stop] - total[s.start]), int(spans[s.stop] - spans[s.start]),
                            hashlib.sha256(kept).hexdigest(), kept if with_kept else None))
        return pa.table([pa.array([r[i] for r in out], f.type) for i, f in enumerate(_RESULT)], schema=_RESULT)
    return run


def remove_repeats(docs: DataFrame, length: int = 50, with_kept: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) of every row of (doc_id, text).

    ``kept`` holds the remaining bytes with ``with_kept``, else null.
    """
    if length < GRAM + 4:
        raise ValueError(f"length must be {GRAM + 4} or more")
    base = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("doc_id"), "text")
    size = base.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))).first()[0] or 0
    n_blocks = max(1, math.ceil(size / BLOCK_BYTES))
    bits = max(4, math.ceil(math.log2(n_blocks)))
    n_parts = 1 << bits
    dealt = (base.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks)))
             .repartition(n_blocks, "block"))
    by_block = dealt.groupBy("block")
    sent = by_block.applyInArrow(_send_anchors(length, bits), "part long, block long, keys binary, counts binary")
    shared = (sent.repartition(n_parts, "part").groupBy("part")
              .applyInArrow(_shared, "block long, part long, keys binary, hot binary"))
    fragments = by_block.cogroup(shared.repartition(n_blocks, "block").groupBy("block")).applyInArrow(
        _send_fragments(length, bits), "part long, block long, " + ", ".join(f"{c} binary" for c in _FRAGMENT_COLUMNS))
    matched = (fragments.repartition(n_parts, "part").groupBy("part").applyInArrow(
        _match(length), "block long, h binary, via binary, off binary, long binary, least binary"))
    return by_block.cogroup(matched.repartition(n_blocks, "block").groupBy("block")).applyInArrow(
        _remove(length, with_kept), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
