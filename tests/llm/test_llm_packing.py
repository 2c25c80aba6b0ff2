"""The sum-of-squares rule against trying every bin, and the dealing of pieces into shards."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from netpulse.llm import packing


def tried(lengths, capacity):
    """Offsets and the gaps left by trying each place: (sum of squares over open bins, gap left) least; an old bin before a new one."""
    gaps, offsets = [], []
    for size in lengths:
        places = []
        for b, gap in [*enumerate(gaps), (len(gaps), capacity)]:
            if gap >= size:
                after = [*gaps[:b], gap - size, *gaps[b + 1 :]]
                cost = sum(after.count(g) ** 2 for g in set(after) if g)
                places.append((cost, b == len(gaps), gap - size))
        _, new, left = min(places)
        # of bins with the same gap any will do; the rule looks at gaps only
        at = len(gaps) if new else max(b for b, g in enumerate(gaps) if g == left + size)
        offsets.append(capacity - size - left)
        gaps[at : at + 1] = [left]
    return offsets, gaps


@pytest.mark.parametrize("capacity, most", [(10, 10), (30, 12), (64, 64), (7, 3)])
def test_rule_against_trying_every_bin(capacity, most):
    rng = np.random.default_rng(capacity)
    for _ in range(30):
        lengths = rng.integers(1, most + 1, rng.integers(1, 60))
        bins, offsets = packing.sum_of_squares(lengths, capacity)
        expected, gaps = tried(lengths.tolist(), capacity)
        assert offsets.tolist() == expected
        fill = np.bincount(bins, lengths)
        assert sorted(capacity - fill.astype(int)) == sorted(gaps)


def test_repeated_rows_fill_all_shards_evenly(spark):
    """Rows that agree in all columns, most of them without an id, from files of unequal size."""
    same = spark.range(9000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"), F.lit(1).cast("long").alias("length"), F.lit(7).cast("long").alias("ids_crc32"))
    more = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"), (F.col("id") % 50 + 1).alias("length"), F.lit(7).cast("long").alias("ids_crc32"))
    placed = packing.pack(same.repartition(3).unionByName(more), 64, 1000).withColumn("shard", F.shiftright("sequence_id", 32))
    sizes = [r["count"] for r in placed.groupBy("shard").count().collect()]
    assert sum(sizes) == 10_000 and len(sizes) == 10 and max(sizes) <= 1100
    ends = placed.groupBy("sequence_id").agg(F.sum("length").alias("used"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert ends.where("used <> end OR end > 64").count() == 0
