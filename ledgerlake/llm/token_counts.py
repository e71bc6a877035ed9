"""Token counts by prefix dynamic programming over a byte-level BPE vocabulary.

A text splits into special strings and pieces (the vocabulary's pre-tokens).
For a piece, ``last[i]`` is the token that ends the encoding of its first i
bytes and ``count[i] = count[i - len(last[i])] + 1``: the encoding of a prefix
is the encoding of a shorter prefix plus the one token that stays next to the
shorter prefix's last token when the two are encoded together. So one pass
gives the exact count at every prefix of a piece, and running sums over pieces
give it at every prefix of a text: budgets and truncation are answered from
the table, nothing is encoded again.

Pieces repeat, so each Python worker keeps a bounded table of piece -> counts.

Defined cases: null and empty texts have 0 bytes and 0 tokens; repeated rows
count each; very long texts and pieces take linear time; empty tables give no
rows; input columns named like the results are replaced.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerlake.llm.kernels import without

#: Fixed value: the split pattern of the byte-level vocabulary.
PIECE = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
CACHE_PIECES = 1_000_000
CACHE_PAIRS = 2_000_000
RESULTS = ("n_bytes", "n_tokens", "over_limit", "kept_chars")


def _byte_letters() -> dict[str, int]:
    """The vocabulary writes bytes as letters: printable ones as themselves, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class PrefixCounter:
    """Exact token counts at every prefix, for one vocabulary file (its content as bytes)."""

    def __init__(self, content: bytes):
        spec = json.loads(content)
        letters = _byte_letters()
        self.specials = [t["content"] for t in spec["added_tokens"]]
        skip = set(self.specials)
        text = {t: bytes(letters[c] for c in t) for t in spec["model"]["vocab"] if t not in skip}
        self.token = {raw: spec["model"]["vocab"][t] for t, raw in text.items()}
        self.raw = {i: raw for raw, i in self.token.items()}
        self.longest = max(map(len, self.token))
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.rank = {(text[a], text[b]): i for i, (a, b) in enumerate(pairs)}
        self.find = regex.compile(PIECE)
        # of special strings that start at one place the longest counts
        strings = sorted(self.specials, key=len, reverse=True)
        self.split = regex.compile("(" + "|".join(map(regex.escape, strings)) + ")") if strings else None
        self.stays: dict[int, bool] = {}
        self.totals: dict[str, int] = {}

    def _encode_pair(self, raw: bytes) -> list[bytes]:
        parts = [raw[i:i + 1] for i in range(len(raw))]
        while len(parts) > 1:
            ranked = [(self.rank.get((a, b), 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))]
            best, i = min(ranked)
            if best == 1 << 60:
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _adjacent(self, a: int, b: int) -> bool:
        """Do tokens a, b stay as they are when their bytes are encoded together?"""
        key = a << 20 | b
        known = self.stays.get(key)
        if known is None:
            if len(self.stays) >= CACHE_PAIRS:
                self.stays.clear()
            left, right = self.raw[a], self.raw[b]
            known = self.stays[key] = self._encode_pair(left + right) == [left, right]
        return known

    def table(self, piece: bytes) -> list[int]:
        """Token counts of the prefixes of 0 .. len(piece) bytes."""
        token, stays, raw_of, adjacent = self.token, self.stays, self.longest, self._adjacent
        n = len(piece)
        count, last = [0] * (n + 1), [-1] * (n + 1)
        for i in range(1, n + 1):
            for at in range(max(0, i - raw_of), i):
                t = token.get(piece[at:i])
                if t is None:
                    continue
                if at == 0:
                    count[i], last[i] = 1, t
                    break
                known = stays.get(last[at] << 20 | t)
                if known if known is not None else adjacent(last[at], t):
                    count[i], last[i] = count[at] + 1, t
                    break
        return count

    def total(self, piece: str) -> int:
        n = self.totals.get(piece)
        if n is None:
            if len(self.totals) >= CACHE_PIECES:
                self.totals.clear()
            n = self.table(piece.encode())[-1]
            if len(piece) <= 64:
                self.totals[piece] = n
        return n

    def segments(self, text: str) -> list[tuple[str, bool]]:
        """The text cut at special strings: (string, is special)."""
        if self.split is None or not any(s in text for s in self.specials):
            return [(text, False)] if text else []
        return [(s, i % 2 == 1) for i, s in enumerate(self.split.split(text)) if s]

    def pieces(self, text: str) -> tuple[list[str], list[int]]:
        """All pieces in order with their token counts; a special string is a piece of one token."""
        names: list[str] = []
        counts: list[int] = []
        for s, special in self.segments(text):
            if special:
                names.append(s)
                counts.append(1)
                continue
            own = self.find.findall(s)
            try:  # nearly always all pieces are known
                counts.extend(map(self.totals.__getitem__, own))
            except KeyError:
                del counts[len(names):]
                counts.extend([self.total(p) for p in own])
            names.extend(own)
        return names, counts

    def _inside(self, previous: str, before: int, name: str, done: int) -> np.ndarray:
        """Exact counts of the prefixes that end in piece ``name``, one a code point.

        ``done`` tokens lie before the piece, ``before`` of them before the
        ``previous`` piece.
        """
        t_ends = np.cumsum([len(c.encode()) for c in name])
        if name in self.specials:
            t = None
            loose = len(name) - 1  # the string is special only once it is whole
        elif name.isspace() and not previous.isspace():
            return done + np.asarray(self.table(name.encode()))[t_ends]
        else:
            t = np.asarray(self.table(name.encode()))
            word = name[1:] if name[0] == " " and len(name) > 1 else name
            contraction = name[0] == "'" and len(name) > 1 and name[1].isalpha()
            loose = len(name) if name.isspace() or contraction else len(name) - len(word)
        out = done + (t[t_ends] if t is not None else np.ones(len(name), np.int64))
        # A cut inside white space, a contraction or a special string, or just behind a leading
        # blank, moves the borders of this piece and the one before it, and of no other.
        for p in range(1, loose + 1):
            out[p - 1] = before + sum(self.pieces(previous + name[:p])[1])
        return out

    def prefixes(self, text: str) -> np.ndarray:
        """Exact token count of ``text[:p]`` for p = 0 .. len(text)."""
        out = [np.zeros(1, np.int64)]
        before = done = 0
        previous = ""
        for name, n in zip(*self.pieces(text), strict=True):
            out.append(self._inside(previous, before, name, done))
            before, done, previous = done, done + n, name
        return np.concatenate(out)

    def longest_prefix(self, names: list[str], counts: list[int], budget: int) -> int:
        """The longest prefix, in code points, of at most ``budget`` tokens, from a text's pieces."""
        sums = np.cumsum(counts)
        j = int(np.searchsorted(sums, budget, side="right"))  # pieces that fit whole
        best = at = sum(map(len, names[:j]))
        before = int(sums[j - 2]) if j > 1 else 0
        done = int(sums[j - 1]) if j else 0
        previous = names[j - 1] if j else ""
        for name, n in zip(names[j:], counts[j:], strict=True):
            if before > budget:
                break
            fits = np.flatnonzero(self._inside(previous, before, name, done) <= budget)
            if len(fits):
                best = at + int(fits[-1]) + 1
            at += len(name)
            before, done, previous = done, done + n, name
        return best


_counters: dict[int, PrefixCounter] = {}


def _counter(content) -> PrefixCounter:
    """One counter per Python worker and vocabulary."""
    if content.id not in _counters:
        _counters.clear()
        _counters[content.id] = PrefixCounter(content.value)
    return _counters[content.id]


class _Content:
    """A broadcast vocabulary with a stable identity for the workers' cache."""

    def __init__(self, broadcast):
        self.broadcast, self.id = broadcast, broadcast._jbroadcast.id()

    def __getstate__(self):
        return self.broadcast, self.id

    def __setstate__(self, state):
        self.broadcast, self.id = state

    @property
    def value(self) -> bytes:
        return self.broadcast.value


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 512, keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (default: all) plus n_bytes, n_tokens, over_limit, kept_chars.

    ``kept_chars`` is the longest prefix in code points of at most ``limit``
    tokens. ``vocabulary`` is a path on the driver; its content (a few MB) is
    broadcast. No shuffle.
    """
    docs = without(docs, *RESULTS)
    keep = docs.columns if keep is None else keep
    with open(vocabulary, "rb") as f:
        content = _Content(docs.sparkSession.sparkContext.broadcast(f.read()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(content)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            n_bytes, n_tokens, kept = [], [], []
            for i in range(len(texts)):
                s = texts[i].as_py() or ""
                names, counts = counter.pieces(s)
                n = sum(counts)
                n_bytes.append(len(s.encode()))
                n_tokens.append(n)
                kept.append(len(s) if n <= limit else counter.longest_prefix(names, counts, limit))
            n_tokens = pa.array(n_tokens, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)) for c in keep]
                + [pa.array(n_bytes, pa.int64()), n_tokens,
                   pa.array(n_tokens.to_numpy() > limit), pa.array(kept, pa.int64())],
                [*keep, *RESULTS])

    schema = T.StructType([docs.schema[c] for c in keep] + [
        T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("over_limit", T.BooleanType()), T.StructField("kept_chars", T.LongType())])
    return docs.mapInArrow(count, schema)
