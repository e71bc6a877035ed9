"""Language ID: nearest of several clustered centroids per language, by cosine, with rejection by distance.

A text becomes counts of letter 1-, 2- and 3-grams (word ends included) hashed
into ``DIMS`` columns, damped, weighted by inverse document frequency and
normalised. Spherical k-means gives ``CENTROIDS`` centroids for each language;
a text gets the language of its nearest centroid. It is rejected where its
cosine to that centroid is below the language's bound: ``MARGIN`` times a low
quantile of the cosines of the language's own labelled texts, so a few wrong
labels do not move it. Texts below ``SHORT`` grams are scaled by the root of
their length, as their cosine shrinks with it.

The classifier is fitted on a bounded sample: about ``SAMPLE`` labelled
documents of each language, picked by a hash of id and text, whole texts. Everything
else sees all rows. Prediction is one pass without a shuffle.

Defined cases: null text or text without letters is ``und`` with score 0 and
rejected; a null label is never learned; ties go to the language first in
order; repeated rows get equal results; very long texts are read whole, in
bounded slices; an empty table gives no rows; if nothing is labelled, every
text is ``und`` and only those without letters are rejected. Input columns named like the results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.kernels import mix, without

DIMS = 4096
CENTROIDS = 4
SAMPLE = 600
ROUNDS = 8
#: A text is rejected below MARGIN times this quantile of the cosines of its language's own labelled texts.
REJECT_QUANTILE = 0.005
MARGIN = 0.7
SHORT = 200
PART_CHARS = 1 << 20
RESULTS = ("lang_pred", "score", "rejected")
_tables: dict[str, np.ndarray] = {}


def _letters() -> np.ndarray:
    """For each code point its lower-case code point if it is a letter, else 0."""
    if "letters" not in _tables:
        table = np.zeros(0x110000, np.uint32)
        for i in range(0x110000):
            c = chr(i)
            if c.isalpha():
                low = c.lower()
                table[i] = ord(low) if len(low) == 1 else i
        _tables["letters"] = table
    return _tables["letters"]


def gram_counts(texts: list[str]) -> np.ndarray:
    """A row of hashed 1- to 3-gram counts for each text (zeros: no letters)."""
    out = np.zeros((len(texts), DIMS), np.float32)
    table = _letters()
    for first, last in _parts(texts):
        code = np.frombuffer("\0".join(texts[first:last]).encode("utf-32-le", "surrogatepass"), np.uint32)
        if not len(code):
            continue
        row = np.repeat(np.arange(last - first), [len(t) + 1 for t in texts[first:last]])[:len(code)]
        low = table[code]
        keep = low != 0
        keep[1:] |= low[:-1] != 0  # the first other character after a word marks its end
        low, row = low[keep].astype(np.uint64), row[keep]
        if not len(low):
            continue
        n = last - first
        total = np.zeros(n * DIMS)
        gram = low.copy()
        for k in (1, 2, 3):
            if k > 1:
                gram = gram[:-1] * np.uint64(0x110000) + low[k - 1:]
            if not len(gram):
                break
            ok = (low[:len(gram)] != 0) | (low[k - 1:] != 0)
            ok &= row[:len(gram)] == row[k - 1:]
            column = (mix(gram + np.uint64(k << 62)) % np.uint64(DIMS)).astype(np.int64)
            total += np.bincount(row[:len(gram)][ok] * DIMS + column[ok], minlength=n * DIMS)
        out[first:last] += total.reshape(n, DIMS)
    return out


def _parts(texts: list[str]) -> Iterator[tuple[int, int]]:
    at = 0
    while at < len(texts):
        to, size = at + 1, len(texts[at])
        while to < len(texts) and size + len(texts[to]) <= PART_CHARS and to - at < 256:
            size += len(texts[to])
            to += 1
        yield at, to
        at = to


def _unit(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.sqrt(counts) * idf
    norm = np.linalg.norm(v, axis=1, keepdims=True)
    return v / np.where(norm > 0, norm, 1)


class Centroids:
    """A fitted classifier: a few MB whatever the corpus."""

    def __init__(self, counts: np.ndarray, labels: list[str], n_centroids: int = CENTROIDS):
        self.langs = sorted(set(labels))
        df = (counts > 0).sum(axis=0)
        self.idf = np.log((1 + len(labels)) / (1 + df)).astype(np.float32) + 1
        unit = _unit(counts, self.idf)
        labels = np.array(labels, dtype=object)
        size = counts.sum(axis=1)
        parts, owner, bound = [], [], []
        for i, lang in enumerate(self.langs):
            own = np.flatnonzero(labels == lang)
            v = unit[own]
            centre = self._cluster(v, n_centroids)
            cos = (v @ centre.T).max(axis=1) / self._reach(size[own])
            bound += [MARGIN * float(np.quantile(cos, REJECT_QUANTILE))] * len(centre)
            owner += [i] * len(centre)
            parts.append(centre)
        self.centre = np.concatenate(parts) if parts else np.zeros((0, DIMS), np.float32)
        self.owner, self.bound = np.array(owner, int), np.array(bound)

    @staticmethod
    def _reach(size: np.ndarray) -> np.ndarray:
        return np.sqrt(np.minimum(1.0, np.maximum(size, 1) / SHORT))

    @staticmethod
    def _cluster(v: np.ndarray, k: int) -> np.ndarray:
        """Spherical k-means; the first centres are far apart, chosen without chance."""
        mean = v.mean(axis=0)
        centre = [mean / (np.linalg.norm(mean) or 1)]
        far = v @ centre[0]
        while len(centre) < min(k, len(v)):
            centre.append(v[int(far.argmin())])
            far = np.maximum(far, v @ centre[-1])
        c = np.array(centre)
        for _ in range(ROUNDS):
            best = (v @ c.T).argmax(axis=1)
            for j in range(len(c)):
                own = v[best == j]
                if len(own):
                    m = own.sum(axis=0)
                    c[j] = m / (np.linalg.norm(m) or 1)
        return c.astype(np.float32)

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        langs: list[str] = []
        score = np.zeros(len(texts))
        rejected = np.ones(len(texts), bool)
        for first, last in _parts(texts):
            counts = gram_counts(texts[first:last])
            size = counts.sum(axis=1)
            if not len(self.centre):
                langs.extend(["und"] * (last - first))  # nothing was learned: only texts without letters go
                rejected[first:last] = size == 0
                continue
            near = _unit(counts, self.idf) @ self.centre.T
            best = near.argmax(axis=1)
            cos = near[np.arange(len(best)), best]
            some = size > 0
            langs.extend(self.langs[self.owner[b]] if ok else "und" for b, ok in zip(best, some, strict=True))
            score[first:last] = np.where(some, np.clip(cos, 0, 1), 0)
            rejected[first:last] = ~some | (cos < self.bound[best] * self._reach(size))
        return langs, score, rejected


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from learning; a null id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, sample: int = SAMPLE) -> Centroids:
    """Fit on about ``sample`` labelled documents of each language that are not held out.

    Only ``text`` and ``lang`` are learned from; a hash of id and text picks the
    sample, so rows that share an id, or have none, are picked one by one. The sample of at most ``sample`` rows a language
    comes to the driver as count vectors.
    """
    usable = docs.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))
                        & F.col("text").isNotNull()).select("doc_id", "lang", "text")
    sizes = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    if not sizes:
        return Centroids(np.zeros((0, DIMS), np.float32), [])
    pick = F.pmod(F.xxhash64("doc_id", F.lit("lang"), "text"), F.lit(1 << 30))
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items()
                           for x in (lang, int(min(1.0, 1.5 * sample / n) * (1 << 30)))])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                picks, langs, texts = (c.to_pylist() for c in batch.slice(first, 256).columns)
                counts = gram_counts(texts)
                some = [i for i in range(len(texts)) if counts[i].any()]
                yield pa.RecordBatch.from_arrays([
                    pa.array([picks[i] for i in some], pa.int64()), pa.array([langs[i] for i in some], pa.string()),
                    pa.array([_pack(counts[i]) for i in some], pa.binary())], ["pick", "lang", "grams"])

    rows = (usable.where(pick < F.element_at(share, F.col("lang"))).select(pick.alias("pick"), "lang", "text")
            .mapInArrow(count, "pick long, lang string, grams binary"))
    taken: dict[str, int] = {}
    vectors, labels = [], []
    for r in sorted(rows.collect(), key=lambda r: (r["lang"], r["pick"], bytes(r["grams"]))):
        if taken.get(r["lang"], 0) < sample:
            taken[r["lang"]] = taken.get(r["lang"], 0) + 1
            vectors.append(_unpack(bytes(r["grams"])))
            labels.append(r["lang"])
    return Centroids(np.array(vectors, np.float32).reshape(-1, DIMS), labels)


def _pack(counts: np.ndarray) -> bytes:
    at = np.flatnonzero(counts)
    return at.astype(np.uint16).tobytes() + counts[at].astype(np.float32).tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    n = len(raw) // 6
    out = np.zeros(DIMS, np.float32)
    out[np.frombuffer(raw, np.uint16, n)] = np.frombuffer(raw, np.float32, n, 2 * n)
    return out


def identify(docs: DataFrame, model: Centroids, keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (default: all) plus lang_pred, score (cosine) and rejected."""
    docs = without(docs, *RESULTS)
    keep = docs.columns if keep is None else keep
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]
            langs, score, rejected = shared.value.predict(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)) for c in keep]
                + [pa.array(langs, pa.string()), pa.array(score), pa.array(rejected)], [*keep, *RESULTS])

    schema = T.StructType([docs.schema[c] for c in keep] + [
        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
        T.StructField("rejected", T.BooleanType())])
    return docs.mapInArrow(predict, schema)
