"""Conversation prefix trie: count-min screening of prefix digests, exact grouping of what may be shared.

A node is a distinct sequence of first turns (role, text); its members are the
conversations that start with it. Steps:

1. Turns are numbered. The rows are range-split on (conversation, order), so
   one conversation may span tasks; positions and digests of a task's first
   conversation get a carry from the tasks before it. There is one carry row
   for each range at most that goes on with a conversation, so the carry
   table is bounded by the number of ranges and broadcast.
2. The digest of a prefix is the exclusive or of the digests of its turns,
   each taken with its position (two times 64 bits).
3. A count-min sketch of fixed size counts all prefix digests, saturating at
   two. It never counts too few, so where a prefix's estimate is one, it is
   proven to be of one conversation, and so are all longer ones: these nodes
   (tails) are emitted from their row alone. Other prefixes are grouped
   exactly; a false alarm costs a row's shuffle and changes no result.
4. Sums over a subtree use representatives. The smallest member of a node is
   its representative and represents all longer prefixes of its own, so a
   conversation represents one path of nodes. A node's sum is the sum over its
   members of what each one's path holds, less what its own representative's
   path holds above it. Hence no iteration over depths: one pass over the
   members with partial aggregation, one running sum along the paths.

The digest of a node's ends is a SHA-256 over all their ids in order, which no
partial aggregation can make: tasks write the ids in pieces, and one task
streams the pieces of a node, holding one at a time.

Defined cases: null role or text is empty; turns go by turn (null first), then
role, then the text's first 64 characters and its digest; repeated rows are
turns of their own; a null conv_id is a conversation of its own, smaller than
all others, shown as null and written as empty text among the ends; very long
texts take part whole; an empty table gives no rows, not even the root; other
columns are ignored. Prefixes are told apart by 128-bit digests.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.kernels import mix, stored

SKETCH_ROWS = 4
SKETCH_BITS = 22
SKETCH_PARTS = 64
TIE_CHARS = 64
_NO_ID = -(1 << 63)
_KEY = ["depth", "x1", "x2"]
_EMPTY = hashlib.sha256(b"").hexdigest()


# --- running values over split ranges -----------------------------------------------------

def _placed(rows: DataFrame, key: str, *order: Column | str) -> DataFrame:
    """The rows range-split on (key, order) and written, with ``at`` (their order) and ``part`` (their range).

    Written because ranges are sampled: all readers have to see the same ones.
    """
    columns = [c for c in rows.columns if not c.startswith("_")]
    split = rows.repartitionByRange(F.col(key), *order).sortWithinPartitions(F.col(key), *order)
    return (stored(split.select(*columns, F.monotonically_increasing_id().alias("at")), "trie-placed")
            .withColumn("part", F.shiftright("at", 33)))


def _spanning(placed: DataFrame, key: str) -> DataFrame:
    """The keys that go on from one range into a later one: one for each range at most."""
    edges = placed.groupBy("part").agg(F.min(key).alias("lo"), F.max(key).alias("hi"))
    before = edges.select(F.col("hi").alias(key), F.col("part").alias("p"))
    after = edges.select(F.col("lo").alias(key), F.col("part").alias("q"))
    return before.join(after, key).where("p < q").select(key).distinct()


def _carry(rows: DataFrame, spanning: DataFrame, key: str, **values: Column) -> DataFrame:
    """(key, part, one column a value, later): what the ranges before hold of a spanning key, and whether more follow."""
    earlier = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.join(F.broadcast(spanning), key).groupBy(key, "part").agg(
        *[v.alias(name) for name, v in values.items()])
    combine = {name: F.bit_xor(name) if name.startswith("x") else F.sum(name) for name in values}
    return totals.select(key, "part", F.lead("part").over(Window.partitionBy(key).orderBy("part")).isNotNull().alias("later"),
                         *[F.coalesce(c.over(earlier), F.lit(0).cast("long")).alias(f"carry_{n}") for n, c in combine.items()])


def _with_carry(rows: DataFrame, carry: DataFrame, key: str) -> DataFrame:
    out = rows.join(F.broadcast(carry), [key, "part"], "left")
    blank = {c: 0 for c in carry.columns if c.startswith("carry_")}
    return out.fillna({**blank, "later": False})


# --- prefixes -----------------------------------------------------------------------------

def _turn_digests(role: Column, text: Column) -> list[Column]:
    return [F.xxhash64(F.lit(salt), role, text).alias(f"c{i}") for i, salt in enumerate((0x71, 0xB3), 1)]


def prefixes(turns: DataFrame, borrowed: DataFrame | None = None, skip: Column | None = None) -> DataFrame:
    """(conv, depth, x1, x2, p1, p2, chars, is_last): one row for each turn of each conversation, written.

    ``x`` is the digest of the turns up to this one, ``p`` of those before it.
    A conversation's first ``skip`` turns are left out (a column over ``turns``,
    equal in all rows of a conversation). ``borrowed`` (conv_id, nth, role,
    text) holds turns that stand before a conversation's own.
    """
    conv = F.coalesce(F.col("conv_id").cast("long"), F.lit(_NO_ID)).alias("conv")
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    facts = [*_turn_digests(role, text), F.length(text).cast("long").alias("chars")]
    left_out = F.lit(0) if skip is None else skip
    rows = turns.select(conv, F.lit(1).cast("long").alias("own"), left_out.cast("long").alias("skip"), *facts,
                        F.col("turn").cast("long").alias("_turn"), role.alias("_role"),
                        F.substring(text, 1, TIE_CHARS).alias("_text"))
    if borrowed is not None:
        rows = rows.unionByName(borrowed.select(
            conv, F.lit(0).cast("long").alias("own"), F.lit(0).cast("long").alias("skip"), *facts,
            F.col("nth").cast("long").alias("_turn"), F.lit("").alias("_role"), F.lit("").alias("_text")))
    rows = rows.withColumn("_row", F.monotonically_increasing_id())
    placed = _placed(rows, "conv", "own", F.asc_nulls_first("_turn"), "_role", "_text", "c1", "c2", "_row")

    spanning = stored(_spanning(placed, "conv"), "trie-spanning")
    here = Window.partitionBy("conv", "part").orderBy("at")
    counts = _carry(placed, spanning, "conv", own=F.sum("own"), other=F.sum(1 - F.col("own")))
    numbered = (_with_carry(placed, counts, "conv").drop("later")
                .withColumn("mine", F.sum("own").over(here) + F.col("carry_own"))
                .withColumn("other", F.sum(1 - F.col("own")).over(here) + F.col("carry_other"))
                .where("own = 0 or mine > skip")
                .withColumn("depth", F.col("other") + F.greatest(F.col("mine") - F.col("skip"), F.lit(0)) * F.col("own"))
                .withColumn("z1", F.xxhash64("c1", "depth")).withColumn("z2", F.xxhash64("c2", "depth"))
                .select("conv", "part", "at", "depth", "z1", "z2", "chars"))
    digests = _carry(numbered, spanning, "conv", x1=F.bit_xor("z1"), x2=F.bit_xor("z2"))
    chain = (_with_carry(numbered, digests, "conv")
             .withColumn("x1", F.bit_xor("z1").over(here).bitwiseXOR(F.col("carry_x1")))
             .withColumn("x2", F.bit_xor("z2").over(here).bitwiseXOR(F.col("carry_x2")))
             .withColumn("is_last", F.lead("at").over(here).isNull() & ~F.col("later")))
    return stored(chain.select(
        "conv", "depth", "x1", "x2", F.col("x1").bitwiseXOR(F.col("z1")).alias("p1"),
        F.col("x2").bitwiseXOR(F.col("z2")).alias("p2"), "chars", "is_last"), "trie-prefixes")


# --- count-min screening ------------------------------------------------------------------

def _cells(x1: np.ndarray, x2: np.ndarray, bits: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row of the sketch, cell) of each digest."""
    h = mix(x1.view(np.uint64) ^ mix(x2.view(np.uint64)))
    step = mix(h ^ np.uint64(0x9FB21C651E98DF25)) | np.uint64(1)
    for j in range(SKETCH_ROWS):
        yield j, ((h + np.uint64(j) * step) >> np.uint64(64 - bits)).astype(np.int64)


def _longs(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False).astype(np.int64)


def _count(bits: int):
    """Counts of a task's digests, saturating at two, in packed parts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((SKETCH_ROWS, 1 << bits), np.uint8)
        for batch in batches:
            for j, cell in _cells(_longs(batch, "x1"), _longs(batch, "x2"), bits):
                cell, many = np.unique(cell, return_counts=True)
                total[j, cell] = np.minimum(total[j, cell] + np.minimum(many, 2), 2)
        packed = [zlib.compress(p.tobytes(), 1) for p in np.split(total.reshape(-1), SKETCH_PARTS)]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(SKETCH_PARTS, dtype=np.int32)), pa.array(packed, pa.binary())],
                                         ["piece", "counts"])
    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One bit a cell: whether it counted two or more."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for piece, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            own = np.frombuffer(zlib.decompress(raw), np.uint8)
            sums[piece] = np.minimum(sums[piece] + own, 2) if piece in sums else own
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.int32()), pa.array([np.packbits(v >= 2).tobytes() for v in sums.values()], pa.binary())],
        ["piece", "counts"])


def screened(chain: DataFrame, bits: int = SKETCH_BITS) -> DataFrame:
    """``chain`` with ``shared`` and ``parent_shared``: whether the estimate of the prefix (of the one before) is above one.

    The sketch has 4 rows of 2**bits cells (7 bits at least). The driver gets and broadcasts a
    bit a cell: 2 MB at 22 bits, whatever the corpus. About one cell a prefix
    screens well; with far fewer everything counts as maybe shared.
    """
    spark = chain.sparkSession
    pieces = (chain.select("x1", "x2").mapInArrow(_count(bits), "piece int, counts binary")
              .repartition(SKETCH_PARTS, "piece").mapInArrow(_merge, "piece int, counts binary"))
    table = np.zeros((SKETCH_PARTS, (SKETCH_ROWS << bits) // SKETCH_PARTS // 8), np.uint8)
    for r in pieces.collect():
        table[r["piece"]] = np.frombuffer(bytes(r["counts"]), np.uint8)
    sketch = spark.sparkContext.broadcast(table.reshape(SKETCH_ROWS, -1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = sketch.value

        def above_one(x1: np.ndarray, x2: np.ndarray) -> np.ndarray:
            out = np.ones(len(x1), bool)
            for j, cell in _cells(x1, x2, bits):
                out &= (twice[j, cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 == 1
            return out

        for batch in batches:
            shared = above_one(_longs(batch, "x1"), _longs(batch, "x2"))
            parent = above_one(_longs(batch, "p1"), _longs(batch, "p2")) | (_longs(batch, "depth") == 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shared), pa.array(parent)],
                                             [*batch.schema.names, "shared", "parent_shared"])

    schema = T.StructType([*chain.schema.fields, T.StructField("shared", T.BooleanType()),
                           T.StructField("parent_shared", T.BooleanType())])
    return stored(chain.mapInArrow(run, schema), "trie-screened")


# --- ends ---------------------------------------------------------------------------------

def _shown(conv: int) -> str:
    return "" if conv == _NO_ID else str(conv)


def _write_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by node and id: the ids of each node in a batch as one piece."""
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([_longs(batch, c) for c in _KEY])
        conv = _longs(batch, "conv")
        at = np.concatenate([[0], np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1, [len(conv)]])
        text = [",".join(map(_shown, conv[a:b].tolist())) for a, b in zip(at[:-1], at[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([*[pa.array(k[at[:-1]]) for k in key], pa.array(conv[at[:-1]]), pa.array(text, pa.string())],
                                         [*_KEY, "first", "ids"])


def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by node and first id: the SHA-256 of each node's ids."""
    node, digest = None, None
    for batch in batches:
        done: list[tuple] = []
        for *key, ids in zip(*[batch.column(i).to_pylist() for i in (0, 1, 2, 4)], strict=True):
            if key != node:
                if digest is not None:
                    done.append((*node, digest.hexdigest()))
                node, digest = key, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], [*_KEY, "ends_sha256"])
    if digest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([c]) for c in (*node, digest.hexdigest())], [*_KEY, "ends_sha256"])


def _ends(last: DataFrame) -> DataFrame:
    keys = "depth long, x1 long, x2 long"
    pieces = (last.select(*_KEY, "conv").repartitionByRange(*_KEY, "conv").sortWithinPartitions(*_KEY, "conv")
              .mapInArrow(_write_ids, f"{keys}, first long, ids string"))
    return pieces.repartition(*_KEY).sortWithinPartitions(*_KEY, "first").mapInArrow(_hash_ids, f"{keys}, ends_sha256 string")


# --- nodes --------------------------------------------------------------------------------

def prefix_trie(turns: DataFrame, borrowed: DataFrame | None = None, skip: Column | None = None,
                bits: int = SKETCH_BITS) -> DataFrame:
    """One row for each node of the trie of (conv_id, turn, role, text); see :func:`prefixes` for the options.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens (over the subtree, each node's members but one
    times the code points of its last text), ends_sha256 (of the members that
    end here).
    """
    flagged = screened(prefixes(turns, borrowed, skip), bits)
    convs = turns.select(F.coalesce(F.col("conv_id").cast("long"), F.lit(_NO_ID)).alias("conv")).distinct()
    started = flagged.where("depth = 1").select("conv", F.lit(False).alias("is_last"))
    zero = F.lit(0).cast("long")
    roots = convs.join(started, "conv", "left").select(
        "conv", *[zero.alias(c) for c in (*_KEY, "p1", "p2", "chars")],
        F.coalesce("is_last", F.lit(True)).alias("is_last"), F.lit(True).alias("shared"), F.lit(False).alias("parent_shared"))
    tails = flagged.where("not shared")
    maybe = flagged.where("shared").unionByName(roots)
    above = [(F.col("depth") - 1).alias("depth"), F.col("p1").alias("x1"), F.col("p2").alias("x2")]

    grouped = maybe.groupBy(*_KEY).agg(
        F.min("conv").alias("rep"), F.count(F.lit(1)).alias("n_convs"), F.max("chars").alias("chars"),
        F.max("p1").alias("p1"), F.max("p2").alias("p2"), F.max("parent_shared").alias("parent_shared"))
    nodes = _placed(grouped.withColumn("val", (F.col("n_convs") - 1) * F.col("chars")), "rep", "depth")
    kids = (nodes.where("parent_shared").select(*above).unionAll(tails.where("parent_shared").select(*above))
            .groupBy(*_KEY).agg(F.count(F.lit(1)).alias("n_children")))

    # what the path of a node's representative holds above the node
    here = Window.partitionBy("rep", "part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    spanning = _spanning(nodes, "rep")
    paths = (_with_carry(nodes, _carry(nodes, spanning, "rep", val=F.sum("val")), "rep")
             .withColumn("higher", F.coalesce(F.sum("val").over(here), zero) + F.col("carry_val"))
             .drop("carry_val", "later", "part", "at"))
    family = stored(paths.join(kids, _KEY, "left").fillna({"n_children": 0}), "trie-nodes")

    # what each conversation's path holds in all, and whether it stands for a leaf
    leaf = tails.where("is_last").select("conv").unionAll(
        family.where("n_children = 0").select(F.col("rep").alias("conv")))
    facts = (family.where("val > 0").select(F.col("rep").alias("conv"), "val", zero.alias("leaf"))
             .unionAll(leaf.select("conv", zero.alias("val"), F.lit(1).cast("long").alias("leaf")))
             .groupBy("conv").agg(F.sum("val").alias("val"), F.sum("leaf").alias("leaf")))
    below = maybe.select("conv", *_KEY).join(facts, "conv").groupBy(*_KEY).agg(
        F.sum("val").alias("held"), F.sum("leaf").alias("n_leaves"))

    parents = family.select(*_KEY, F.col("rep").alias("parent"))
    told = (family.join(below, _KEY, "left").join(_ends(maybe.where("is_last")), _KEY, "left")
            .join(parents.select((F.col("depth") + 1).alias("depth"), F.col("x1").alias("p1"), F.col("x2").alias("p2"), "parent"),
                  ["depth", "p1", "p2"], "left"))
    shown = lambda c: F.nullif(F.col(c), F.lit(_NO_ID))
    exact = told.select(
        shown("rep").alias("conv_id"), "depth",
        F.when(F.col("depth") > 0, F.when(F.col("parent_shared"), shown("parent")).otherwise(shown("rep"))).alias("parent_conv_id"),
        "n_convs", "n_children", F.coalesce("n_leaves", zero).alias("n_leaves"),
        (F.coalesce("held", zero) - F.col("higher")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"))

    own_id = F.when(F.col("conv") == _NO_ID, "").otherwise(F.col("conv").cast("string"))
    first = tails.where("parent_shared").select(*above, F.col("conv"), F.col("is_last")).join(parents, _KEY).select(
        "conv", (F.col("depth") + 1).alias("depth"), "is_last", "parent")
    alone = first.unionByName(tails.where("not parent_shared").select(
        "conv", "depth", "is_last", F.col("conv").alias("parent")))
    one = F.lit(1).cast("long")
    return exact.unionByName(alone.select(
        shown("conv").alias("conv_id"), "depth", shown("parent").alias("parent_conv_id"), one.alias("n_convs"),
        F.when(F.col("is_last"), zero).otherwise(one).alias("n_children"), one.alias("n_leaves"), zero.alias("saved_tokens"),
        F.when(F.col("is_last"), F.sha2(own_id, 256)).otherwise(F.lit(_EMPTY)).alias("ends_sha256")))
