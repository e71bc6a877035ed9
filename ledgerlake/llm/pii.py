"""Personal data by base patterns and a skip-chain conditional random field.

Base patterns find e-mail and IP addresses, card and phone numbers. Where two
entities touch (a phone number followed by a card number), the patterns match
them as one string and drop it, and a number written another way the second
time is missed. The field labels the tokens that hold a digit or an at sign:

* node potentials from the token's shape,
* chain potentials between neighbouring tokens,
* skip potentials that tie distant tokens of one entity together, however it is
  written: the same address, IP or six digits, or, over runs of numbers apart by
  one blank, the same last 7, 10 or 16 digits before a token's end. All places
  of a key meet in one hub, a hidden label of its own, so links stay linear: a
  token ends three keys, and a key holds 16 digits at most,

with loopy sum-product message passing over all documents of a batch at once,
each until its messages settle. Tokens in a base span are observed, and so are
the hubs they meet in: a number that the patterns find once labels its other spellings. Runs of tokens labelled
as an entity outside every base span become further spans if they pass the
kind's check (digits, Luhn) or repeat an entity of the document.

The weights are trained here by pseudo-likelihood on tokens of a bounded
sample of documents (``TRAIN_DOCS`` by hash of the id, ``TRAIN_TOKENS`` tokens)
with the base patterns' labels; for training each number is written again in
groups of digits, next to a decoy that is none. Search covers all texts whole.

Defined cases: null and empty texts have no spans; repeated rows get equal
results; very long texts take linear time (patterns restart nowhere); an empty
table gives no rows; a corpus without any entity gives untrained weights of
zero, so nothing is added; a field whose messages do not settle is read after
``MOST_ROUNDS``. Input columns named like the results are replaced.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.kernels import without

#: The kinds in the order in which spans are listed.
KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
TRAIN_DOCS = 20_000
TRAIN_TOKENS = 40_000
#: Messages have settled once none of a document moves by more (natural logarithms).
SETTLED = 1e-4
MOST_ROUNDS = 1000
#: Added to the score of an observed label: more than any number of messages can outvote.
OBSERVED = 1e9
SURE = 0.5
#: Digits before a token's end by which numbers meet, and the most digits of a number.
TAILS = (7, 10, 16)
MOST_DIGITS = 19
RESULTS = ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added")

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# Digits before a failing start belong to its run, so no start inside a run can match.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TOKEN = re.compile(r"\S*[0-9@]\S*")
_SOME = re.compile(r"[0-9@]")
_CORE = re.compile(r"[+(]*[0-9A-Za-z](?:.*[0-9A-Za-z)])?")
_NUMBER = re.compile(r"[0-9().+-]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        total += n if i % 2 == 0 else (2 * n - 9 if n > 4 else 2 * n)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) in code points, by kind, then start."""
    out = []
    if "@" in text:
        end = 0
        for m in _DOMAIN.finditer(text):
            at = m.start()
            while at > end and text[at - 1] in _LOCAL:
                at -= 1
            if at < m.start():
                out.append((0, at, m.end()))
                end = m.end()
    if not _SOME.search(text):
        return out
    out.extend((1, *m.span()) for m in _IP.finditer(text)
               if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")))
    for m in _CARD.finditer(text):
        d = _digits(m.group())
        if 16 <= len(d) <= 19 and luhn(d):
            out.append((2, *m.span()))
    out.extend((3, *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m.group())) <= 15)
    return out


class Token:
    """A candidate token: its core's place in the text, its digits, and whether it can be part of a number."""

    __slots__ = ("start", "end", "text", "digits", "number")

    def __init__(self, start: int, text: str):
        self.start, self.end, self.text = start, start + len(text), text
        self.digits = _digits(text)
        self.number = bool(self.digits) and _NUMBER.fullmatch(text) is not None

    def follows(self, before: Token) -> bool:
        """Whether it can go on a number that ``before`` is part of."""
        return self.number and before.number and self.start - before.end == 1 and self.text[0] != "+"

    def key(self) -> str | None:
        """What it shares with other spellings on its own, without its neighbours."""
        if "@" in self.text:
            found = base_spans(self.text)
            return (self.text[found[0][1]:found[0][2]] if found and found[0][0] == 0 else self.text).lower()
        return self.text if _IP.fullmatch(self.text) else self.digits if len(self.digits) == 6 else None


def tokens(text: str) -> list[Token]:
    out = []
    for m in _TOKEN.finditer(text):
        core = _CORE.search(m.group())
        if core:
            out.append(Token(m.start() + core.start(), core.group()))
    return out


def _shape(t: Token, before: Token | None, text: str) -> list[float]:
    n, s = len(t.digits), t.text
    parts = s.split(".")
    near = before is not None and t.start - before.end <= 1
    return [
        1.0, "@" in s, "@" in s and "." in s.partition("@")[2],
        len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) < 4 and int(p) < 256 for p in parts),
        16 <= n <= 19, 16 <= n <= 19 and luhn(t.digits), 10 <= n <= 15, 7 <= n <= 9, 4 <= n <= 6, n <= 3,
        s[0] == "+", s[0] == "(" and s[-1] == ")", "-" in s, s.isdigit(), any(c.isalpha() for c in s),
        near and before.text[0] == "+", near and before.text[0] == "(",
        t.start > 0 and text[t.start - 1] == "=", n > 19,
    ]


N_SHAPES = 19


def _hubs(own: list[Token]) -> list[list[tuple[int, int]]]:
    """(token, its place's last token) of every key that two places or more share."""
    places: dict[tuple, list[tuple[int, int]]] = {}
    run = 0  # first token of the number that the token may belong to
    for i, t in enumerate(own):
        if i and not t.follows(own[i - 1]):
            run = i
        alone = t.key()
        if alone is not None:
            places.setdefault((0, alone), []).append((i, i))
        if not t.digits or "@" in t.text:
            continue
        digits, nth = t.digits[-TAILS[-1]:], [i] * min(len(t.digits), TAILS[-1])
        j = i
        while len(digits) < TAILS[-1] and j > run:
            j -= 1
            more = own[j].digits[len(digits) - TAILS[-1]:]
            digits, nth = more + digits, [j] * len(more) + nth
        least = 0
        for tail in TAILS:  # a longer key links the tokens that no shorter one reaches, or its first
            if len(digits) >= tail:
                held = places.setdefault((tail, digits[-tail:]), [])
                reached = set(nth[len(nth) - least:])
                further = [j for j in dict.fromkeys(nth[-tail:len(nth) - least]) if j not in reached]
                held.extend((j, i) for j in further or [nth[-tail]])
                least = tail
    return [held for held in places.values() if held and held[0][1] != held[-1][1]]


def _graph(texts: list[str]) -> tuple[list[list[Token]], np.ndarray, np.ndarray, np.ndarray, np.ndarray, list]:
    """Tokens of each text; of all: shapes, edges (u, v) of the chain and (token, hub) of the skip links, the text of
    each node (hubs come after all tokens), and the hubs' lists."""
    per_text, shapes, chain, skip, group, hubs, hub_group = [], [], [], [], [], [], []
    for number, text in enumerate(texts):
        own = tokens(text) if _SOME.search(text) else []
        first = len(shapes)
        before = None
        for i, t in enumerate(own):
            shapes.append(_shape(t, before, text))
            if before is not None and text[before.end:t.start].isspace() and t.start - before.end <= 2:
                chain.append((first + i - 1, first + i))
            before = t
        for held in _hubs(own):
            skip.extend((first + i, len(hubs)) for i in dict.fromkeys(i for i, _ in held))
            hubs.append(held)
            hub_group.append(number)
        group.extend([number] * len(own))
        per_text.append(own)
    links = np.array(skip, np.int64).reshape(-1, 2)
    links[:, 1] += len(shapes)
    return (per_text, np.array(shapes, np.float64).reshape(-1, N_SHAPES),
            np.array(chain, np.int64).reshape(-1, 2), links, np.array(group + hub_group, np.int64), hubs)


def _linked_labels(y: np.ndarray, hubs: list[list[tuple[int, int]]]) -> np.ndarray:
    """The label that most linked tokens of other places have, by token; -1 without a link."""
    votes = np.zeros((len(y), len(LABELS)), np.int64)
    for held in hubs:
        token, place = np.array(held).T
        _, place = np.unique(place, return_inverse=True)
        here = np.zeros((place.max() + 1, len(LABELS)), np.int64)
        np.add.at(here, (place, y[token]), 1)
        np.add.at(votes, token, here.sum(axis=0) - here[place])
    return np.where(votes.any(axis=1), votes.argmax(axis=1), -1)


def _labels(own: list[Token], spans: list[tuple[int, int, int]]) -> list[int]:
    """The base kind of each token; of several spans on it, the first listed."""
    out = [0] * len(own)
    starts = [t.start for t in own]
    for kind, start, end in reversed(spans):
        i = int(np.searchsorted(starts, start, side="right")) - 1
        for j in range(max(i, 0), len(own)):
            if own[j].start >= end:
                break
            if own[j].end > start:
                out[j] = kind + 1
    return out


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


class SkipChain:
    """Weights of the field: shapes x labels, and label pairs on chain and skip links."""

    def __init__(self, shape: np.ndarray, chain: np.ndarray, skip: np.ndarray):
        self.shape, self.chain, self.skip = shape, chain, skip

    @classmethod
    def train(cls, x: np.ndarray, y: np.ndarray, before: np.ndarray, after: np.ndarray, link: np.ndarray,
              steps: int = 1000, rate: float = 1.0, penalty: float = 1e-4) -> SkipChain:
        """Maximum pseudo-likelihood; a neighbour's label of -1 means no neighbour.

        Every token counts four times: with all its neighbours' labels, and
        with those on the chain, on the links or on both unknown, so that no
        kind of potential leans on another. Equal rows are one, with a weight.
        """
        k = len(LABELS)
        w, c, s = np.zeros((x.shape[1], k)), np.zeros((k, k)), np.zeros((k, k))
        if not len(x):
            return cls(w, c, s)
        gone = np.full(len(y), -1)
        rows = np.concatenate([np.column_stack([x, y, *sides]) for sides in (
            (before, after, link), (before, after, gone), (gone, gone, link), (gone, gone, gone))])
        rows, times = np.unique(rows, axis=0, return_counts=True)
        x = rows[:, :-4]
        y, before, after, link = rows[:, -4:].astype(np.int64).T
        one = np.eye(k + 1)[:, :k]  # the last row, of label -1, is zero
        b, a, z, t = one[before], one[after], one[link], one[y]
        share = (times / times.sum())[:, None]
        speed = [np.zeros_like(w), np.zeros_like(c), np.zeros_like(s)]
        for _ in range(steps):
            score = x @ w + b @ c + a @ c.T + z @ (s + s.T) / 2
            p = np.exp(score - score.max(axis=1, keepdims=True))
            d = (t - p / p.sum(axis=1, keepdims=True)) * share
            grads = (x.T @ d - penalty * w, b.T @ d + d.T @ a - penalty * c,
                     (z.T @ d + d.T @ z) / 2 - penalty * s)
            for v, g, m in zip((w, c, s), grads, speed, strict=True):
                m *= 0.9
                m += rate * g
                v += m
        return cls(w, c, (s + s.T) / 2)

    def marginals(self, x: np.ndarray, chain: np.ndarray, skip: np.ndarray, group: np.ndarray | None = None,
                  observed: np.ndarray | None = None) -> np.ndarray:
        """Label probabilities of every token after loopy sum-product messages.

        ``skip`` links tokens to hubs, which are numbered behind the tokens.
        ``group`` is the document of each token and hub: every document stops
        when its own messages have settled, whatever else is in the batch.
        ``observed`` are known labels of tokens and hubs, 0 for none.
        """
        k, n_tokens = len(LABELS), len(x)
        n = max(n_tokens, int(skip[:, 1].max()) + 1 if len(skip) else 0)
        group = np.zeros(n, np.int64) if group is None else group
        node = np.zeros((n, k))
        node[:n_tokens] = x @ self.shape
        if observed is not None:
            known = np.flatnonzero(observed)
            node[known, observed[known]] += OBSERVED
        u = np.concatenate([chain[:, 0], skip[:, 0], chain[:, 1], skip[:, 1]])
        v = np.concatenate([chain[:, 1], skip[:, 1], chain[:, 0], skip[:, 0]])
        m = len(u) // 2
        kind = np.repeat(np.arange(4), [len(chain), len(skip)] * 2)
        pair = np.stack([self.chain, self.skip, self.chain.T, self.skip.T])
        back = np.concatenate([np.arange(m, 2 * m), np.arange(m)])
        message = np.zeros((len(u), k))
        belief = node
        live, of = np.arange(len(u)), group[u]
        for _ in range(MOST_ROUNDS):
            if not len(live):
                break
            out = _logsumexp((belief[u[live]] - message[back[live]])[:, :, None] + pair[kind[live]], 1)
            new = 0.5 * message[live] + 0.5 * (out - _logsumexp(out, 1)[:, None])
            moved = np.zeros(len(group))  # by document; there are no more documents with nodes than nodes
            names, at = np.unique(of[live], return_inverse=True)
            np.maximum.at(moved, at, np.abs(new - message[live]).max(axis=1))
            message[live] = new
            belief = node + np.stack([np.bincount(v, message[:, j], n) for j in range(k)], axis=1)
            live = live[moved[at] > SETTLED]
        belief = belief[:n_tokens]
        return np.exp(belief - _logsumexp(belief, 1)[:, None]) if n_tokens else np.zeros((0, k))


def _added(own: list[Token], p: np.ndarray, base: list[tuple[int, int, int]], text: str) -> list[tuple[int, int, int]]:
    """Spans of labelled tokens outside the base spans."""
    if not own:
        return []
    covered = np.array(_labels(own, base)) > 0
    label = np.where((p.max(axis=1) >= SURE) & ~covered, p.argmax(axis=1), 0)
    known = {(k, _digits(text[s:e])) for k, s, e in base}
    phones = {d[-7:]: d for k, d in known if k == 3}

    def judge(kind: int, i: int, j: int) -> int:
        """2: tokens i to j - 1 repeat an entity; 1: they pass the kind's check; 0: neither."""
        s = text[own[i].start:own[j - 1].end]
        d = _digits(s)
        if kind == 0:
            return int("@" in s[1:-1] and "." in s.partition("@")[2])
        if kind == 2:
            return 0 if not 16 <= len(d) <= MOST_DIGITS else 2 if (2, d) in known else int(luhn(d))
        if kind != 3 or len(d) < 7:
            return 0
        other = phones.get(d[-7:], "")
        if other and (other.endswith(d) or d.endswith(other)) and len(d) <= 15:
            return 2
        return int(8 <= len(d) <= 15 and s[0] == "+")

    out, i = [], 0
    while i < len(own):
        kind, ends, n = int(label[i]) - 1, [], 0
        if kind >= 0:
            j = i
            while j < len(own) and label[j] == kind + 1 and (j == i or (kind > 1 and own[j].follows(own[j - 1]))):
                n += len(own[j].digits)
                j += 1
                if j > i + 1 and n > MOST_DIGITS:
                    break
                ends.append((judge(kind, i, j), j))
        best = max(ends, default=(0, 0))  # an entity known from elsewhere first, then the longest
        if best[0]:
            start, end = own[i].start, own[best[1] - 1].end
            out.append((kind, start, end))
            known.add((kind, _digits(text[start:end])))
            if kind == 3:
                phones.setdefault(_digits(text[start:end])[-7:], _digits(text[start:end]))
            i = best[1]
        else:
            i += 1
    return out


def find_spans(texts: list[str], field: SkipChain) -> list[tuple[list, list]]:
    """For each text its base spans and the field's further ones."""
    per_text, x, chain, skip, group, hubs = _graph(texts)
    base = [base_spans(text) for text in texts]
    observed = np.array([y for own, spans in zip(per_text, base, strict=True) for y in _labels(own, spans)], np.int64)
    votes = np.zeros((len(x) + len(hubs), len(LABELS)), np.int64)
    np.add.at(votes, (skip[:, 1], observed[skip[:, 0]]), 1)
    known = votes[len(x):, 1:]  # one observed place tells what a hub is, however many places are not
    seen = np.where(known.any(axis=1), known.argmax(axis=1) + 1, 0)
    p = field.marginals(x, chain, skip, group, np.concatenate([observed, seen]))
    out, at = [], 0
    for text, own, spans in zip(texts, per_text, base, strict=True):
        out.append((spans, _added(own, p[at:at + len(own)], spans, text)))
        at += len(own)
    return out


def _listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Every span becomes ``[KIND]``; overlapping spans become one, named by the first."""
    out, at = [], 0
    for k, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s >= at:
            out.append(text[at:s])
            out.append(f"[{KINDS[k].upper()}]")
        at = max(at, e)
    return "".join([*out, text[at:]]) if out else text


def _respelled(text: str, own: list[Token], base: list[tuple[int, int, int]]) -> tuple[str, list[tuple[int, int, int]]]:
    """The text with each of its numbers written again in groups of digits, and the added spans of its kinds.

    Behind each number stands a decoy: other digits in the same groups, no
    entity, met by no link. So links have to tell the two apart, not shapes.
    Last come all numbers once more, one blank apart.
    """
    spans = [s for s in base if s[0] > 1]
    spans += [(-1, t.start, t.end) for t, y in zip(own, _labels(own, base), strict=True) if not y and t.number and len(t.digits) > 6]
    added, again = [], []

    def write(kind: int, words: str) -> None:
        nonlocal text
        if kind >= 0:
            added.append((kind, len(text), len(text) + len(words)))
        text += words

    for kind, start, end in spans:
        d = _digits(text[start:end])
        d = d if kind == 2 else d[-10:]
        size = 4 if kind == 2 else 2 + int(d[-1]) % 2
        groups = [d[i:i + size] for i in range(0, len(d), size)]
        words = " ".join(groups)
        text += " or "
        write(kind, words)
        text += " not "
        write(-1, words.translate(_OTHER_DIGITS))
        again.append((kind, words))
    text += " all"
    for kind, words in again:
        text += " "
        write(kind, words)
    return text, added


_OTHER_DIGITS = str.maketrans("0123456789", "3456789012")


def _training_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        picks, texts = (c.to_pylist() for c in batch.columns)
        for pick, text in zip(picks, texts, strict=True):
            base = base_spans(text)
            text, added = _respelled(text, tokens(text), base)
            (own,), x, chain, _, _, hubs = _graph([text])
            if not own:
                continue
            y = np.array(_labels(own, base + added))
            before, after = np.full(len(own), -1), np.full(len(own), -1)
            before[chain[:, 1]], after[chain[:, 0]] = y[chain[:, 0]], y[chain[:, 1]]
            link = _linked_labels(y, hubs)
            yield pa.RecordBatch.from_arrays([
                pa.array([pick] * len(own), pa.int64()), pa.array(np.arange(len(own))),
                pa.array([r.astype(np.uint8).tobytes() for r in x], pa.binary()),
                *(pa.array(v.astype(np.int32)) for v in (y, before, after, link))],
                ["pick", "place", "x", "y", "b", "a", "z"])


def train(docs: DataFrame) -> SkipChain:
    """Train on at most ``TRAIN_TOKENS`` tokens of about ``TRAIN_DOCS`` documents."""
    n = docs.count()
    pick = F.pmod(F.xxhash64("doc_id", F.lit("pii")), F.lit(1 << 30))
    rows = (docs.where(F.col("text").rlike("[0-9@]") & (pick < int(min(1.0, TRAIN_DOCS / max(n, 1)) * (1 << 30))))
            .select(pick.alias("pick"), "text")
            .mapInArrow(_training_rows, "pick long, place long, x binary, y int, b int, a int, z int")
            .orderBy("pick", "place", "x", "y", "b", "a", "z").limit(TRAIN_TOKENS).collect())
    x = np.array([np.frombuffer(bytes(r["x"]), np.uint8) for r in rows], np.float64).reshape(-1, N_SHAPES)
    y, b, a, z = (np.array([r[c] for r in rows], np.int64) for c in "ybaz")
    return SkipChain.train(x, y, b, a, z)


def find_personal_data(docs: DataFrame, field: SkipChain, keep: list[str] | None = None,
                       redacted: bool = False) -> DataFrame:
    """Columns ``keep`` (default: all) plus the counts and lists of spans.

    n_* count base spans, base_sha256 digests them, ``spans`` lists all spans,
    n_added counts the field's. With ``redacted``, ``text`` has the spans
    replaced by their kinds (a null text stays null). No shuffle.
    """
    docs = without(docs, *RESULTS)
    keep = docs.columns if keep is None else keep
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for first in range(0, batch.num_rows, 1000):
                rows = batch.slice(first, 1000)
                texts = rows.column(at).to_pylist()
                found = find_spans([t or "" for t in texts], shared.value)
                columns = {c: rows.column(rows.schema.get_field_index(c)) for c in keep}
                if redacted:
                    columns["text"] = pa.array([None if t is None else redact(t, b + a) for t, (b, a) in
                                                zip(texts, found, strict=True)], rows.column(at).type)
                counts = np.zeros((len(found), len(KINDS)), np.int64)
                for i, (base, _) in enumerate(found):
                    for k, _, _ in base:
                        counts[i, k] += 1
                yield pa.RecordBatch.from_arrays(
                    [*columns.values(), *(pa.array(counts[:, k]) for k in range(len(KINDS))),
                     pa.array([hashlib.sha256(_listed(b).encode()).hexdigest() for b, _ in found], pa.string()),
                     pa.array([_listed(b + a) for b, a in found], pa.string()),
                     pa.array([len(a) for _, a in found], pa.int64())], [*columns, *RESULTS])

    schema = T.StructType([docs.schema[c] for c in keep]
                          + [T.StructField(f"n_{k}", T.LongType()) for k in KINDS]
                          + [T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType()),
                             T.StructField("n_added", T.LongType())])
    return docs.mapInArrow(search, schema)
