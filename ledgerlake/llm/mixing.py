"""Mixing sources to target weights: Poisson replication by an inverted, hash-seeded distribution.

Each source gets a mean repetition rate that brings its share of all
characters to its target weight. A document's count is the inverse Poisson
distribution function at a uniform number made from a hash of (seed, doc_id,
text), so rows that share an id, or have none, draw on their own, and a rerun, a retry or another partitioning gives the same rows. Documents are
exploded by their counts and brought into a global random order by a hash.

Only DataFrame functions run here. A rate above ``PIECE`` is a sum of equal
Poisson pieces with a uniform number each, which keeps the inversion exact for
any rate (exp(-rate) never underflows) without a cap on counts.

Defined cases: a null source is a source; null or empty texts have no
characters and repeat at their source's rate; a source without any characters
keeps rate 1; with given weights, sources that have none are left out and the
rest is normalised over the sources present; a null doc_id or text hashes as
an empty string; rows of equal id and text have equal counts; an empty table gives no rows; input
columns named ``replica`` or ``shuffle_key`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.kernels import free_name, without

PIECE = 16.0
# P(Poisson(16) > 120) is below 2**-150, far under the 2**-52 steps of the uniform number.
STEPS = 120
#: Up to so many sources their table (two numbers and a short array a row, about 1 kB) is broadcast.
BROADCAST_SOURCES = 10_000


def row_key() -> Column:
    """What draws for a row: a digest of its id and its whole text."""
    whole = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("doc_id", "text")]
    return F.md5(F.concat(whole[0], F.lit("|"), F.md5(whole[1])))


def uniform(seed: str, *parts: Column) -> Column:
    """A double in [0, 1) with 52 random bits from an md5 of the parts."""
    key = F.concat_ws("|", F.lit(seed), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None,
                 alpha: float = 0.5) -> tuple[DataFrame, int]:
    """(source, n_chars, rate) with the mean repetition rate of each source, and the number of sources.

    Without ``weights`` the target share is proportional to characters to the
    power ``alpha`` (1 keeps the shares, 0 makes them equal). Three totals
    come to the driver.
    """
    sizes = docs.groupBy("source").agg(F.sum(F.coalesce(F.length("text"), F.lit(0)).cast("long")).alias("n_chars"))
    if weights is None:
        wanted = F.when(F.col("n_chars") > 0, F.pow(F.col("n_chars").cast("double"), F.lit(alpha))).otherwise(0.0)
    else:
        if not weights or any(w < 0 for w in weights.values()):
            raise ValueError("weights need at least one source and no negative number")
        table = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])
        wanted = F.coalesce(F.try_element_at(table, F.col("source")).cast("double"), F.lit(0.0))
        wanted = F.when(F.col("n_chars") > 0, wanted).otherwise(0.0)
    weighed = sizes.withColumn("w", wanted)
    total = weighed.agg(F.count(F.lit(1)).alias("n"), F.sum("w").alias("w"), F.sum("n_chars").alias("c")).first()
    share = F.col("w") / F.lit(float(total["w"] or 1.0)) * F.lit(total["c"] or 0) / F.col("n_chars")
    return weighed.select("source", "n_chars", F.when(F.col("n_chars") > 0, share).otherwise(
        1.0 if weights is None else 0.0).alias("rate")), total["n"]


def _inverse_table(rate: Column) -> Column:
    """The distribution function of Poisson(rate) at 0 .. STEPS - 1."""
    start = F.struct(F.exp(-rate).alias("p"), F.array(F.exp(-rate)).alias("cdf"))

    def step(s: Column, k: Column) -> Column:
        p = s["p"] * rate / k
        return F.struct(p.alias("p"), F.concat(s["cdf"], F.array(F.element_at(s["cdf"], -1) + p)).alias("cdf"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(STEPS - 1)), start, step, lambda s: s["cdf"])


def mix_sources(docs: DataFrame, weights: dict[str, float] | None = None, alpha: float = 0.5,
                seed: str = "mix-1") -> DataFrame:
    """All columns of ``docs`` plus replica (from 1) and shuffle_key, in global random order.

    The rates' table holds one row per source and is broadcast only where it
    was counted to hold at most ``BROADCAST_SOURCES`` rows; beyond that the
    join shuffles and AQE splits the hot sources. The final order needs no
    sample: ``shuffle_key`` is uniform, so its leading digits cut it into as
    many equal ranges as the session has shuffle partitions.
    """
    docs = without(docs, "replica", "shuffle_key")
    source, pieces, cdf, n, key = (free_name(docs, x) for x in ("_source", "_pieces", "_cdf", "_n", "_key"))
    by_source, n_sources = source_rates(docs, weights, alpha)
    rates = (by_source
             .withColumn(pieces, F.greatest(F.ceil(F.col("rate") / PIECE), F.lit(1)).cast("int"))
             .select(F.col("source").alias(source), pieces, _inverse_table(F.col("rate") / F.col(pieces)).alias(cdf)))
    few = n_sources <= BROADCAST_SOURCES
    joined = docs.withColumn(key, row_key()).join(F.broadcast(rates) if few else rates, docs["source"].eqNullSafe(rates[source]))
    # one digest a draw: the numbers first, then each one's place in the distribution function
    numbers = F.transform(F.sequence(F.lit(1), F.col(pieces)), lambda j: uniform(seed, F.col(key), j))
    draws = F.transform(numbers, lambda u: F.size(F.filter(cdf, lambda c: c <= u)))
    counted = joined.withColumn(n, F.aggregate(draws, F.lit(0), lambda a, x: a + x)).where(F.col(n) > 0)
    order = F.substring(F.md5(F.concat_ws("|", F.lit(seed), F.lit("order"), F.col(key), F.col("replica").cast("string"))), 1, 16)
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.floor(F.conv(F.substring("shuffle_key", 1, 8), 16, 10).cast("double") * ranges / float(1 << 32)).cast("int")
    return (counted.select(*docs.columns, key, F.explode(F.sequence(F.lit(1), F.col(n))).alias("replica"))
            .withColumn("shuffle_key", order).drop(key)
            .repartitionById(ranges, place).sortWithinPartitions("shuffle_key", "doc_id", "replica"))
