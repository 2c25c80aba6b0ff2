"""Samples that depend on the rows alone, not on how they are partitioned.

A row is named by a digest of its content and the number of its copy, and draws by a
hash of that name.  Copies of a row cannot be told apart, so which of them bears which
number does not matter: it is enough to count them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from netpulse import fixed

DIGEST = ["__digest", "__digest2"]
# Copies of a row that one task numbers.
COPIES = 100_000


def spare(rows: int) -> float:
    """A few more than ``rows``: thinning to this expectation practically never leaves fewer."""
    return float(rows + 6 * math.isqrt(rows) + 50)


def with_digest(df: DataFrame) -> DataFrame:
    """Add 128 bits of hash over all columns, by name."""
    columns = sorted(df.columns)
    return df.withColumns({DIGEST[0]: F.xxhash64(*columns), DIGEST[1]: F.xxhash64(F.lit("second"), *columns)})


def in_shares(counted: DataFrame, copies: str = "copies") -> DataFrame:
    """Rows with a number of copies as shares of at most ``COPIES``: ``first`` and ``last`` number of each.

    The shares of often repeated rows are dealt out, so that no task numbers them all.
    """
    once = counted.where(F.col(copies) <= COPIES).withColumn("first", F.lit(0).cast("long"))
    often = counted.where(F.col(copies) > COPIES)
    often = often.withColumn("first", F.explode(F.sequence(F.lit(0).cast("long"), F.col(copies) - 1, F.lit(COPIES).cast("long"))))
    shares = once.unionByName(often.repartition(*DIGEST, "first"))
    return shares.withColumn("last", F.least(F.col("first") + COPIES, F.col(copies)) - 1)


def draw(seed: int, *name: Column | str) -> Column:
    """Uniform in [0, 1) by a hash."""
    return F.pmod(F.xxhash64(F.lit(seed), *name), F.lit(1 << 52)) / F.lit(float(1 << 52))


def sample_cap(df: DataFrame, cap: int, seed: int = fixed.SEED) -> DataFrame:
    """Uniform sample without replacement of ``cap`` rows, all where there are no more; the same for any partitioning.

    Every copy of a row draws on its own.  Only digests are shuffled, thinned to a little
    over ``cap`` before they are sorted; the drawn rows are then picked out of ``df``.
    """
    named = with_digest(df)
    counted = named.groupBy(*DIGEST).agg(F.count(F.lit(1)).alias("copies"))
    total = counted.agg(F.sum("copies")).first()[0] or 0
    if total <= cap:
        return df
    numbered = in_shares(counted).select(*DIGEST, F.explode(F.sequence("first", "last")).alias("copy"))
    drawn = numbered.withColumn("draw", draw(seed, *DIGEST, "copy"))
    limit = spare(cap) / total
    thinned = drawn.where(F.col("draw") < limit)
    while limit < 1 and thinned.count() < cap:
        limit *= 2
        thinned = drawn.where(F.col("draw") < limit)
    chosen = thinned.orderBy("draw", *DIGEST, "copy").limit(cap).groupBy(*DIGEST).agg(F.count(F.lit(1)).cast("int").alias("__times"))
    found = named.join(chosen, DIGEST).dropDuplicates(DIGEST)
    return found.withColumn("__times", F.explode(F.array_repeat(F.lit(0), F.col("__times")))).select(*df.columns)
