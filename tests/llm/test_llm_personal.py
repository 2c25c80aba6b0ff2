"""The judge of proposed spans learns from every proposal."""

from pyspark.sql import functions as F

from netpulse.llm import personal
from netpulse.session import stage


def test_every_proposal_takes_part_in_the_fit(spark):
    """One kind's proposals have only high hashes: 25,000 others come before them, more than the old bound of 20,000."""
    place = spark.range(200_000).select(F.col("id").alias("doc_id"), F.lit(0).alias("start"), F.lit(5).alias("end"), (F.col("id") % 2).alias("outcome"))
    own = {"kind": F.when(F.col("doc_id") % 3 == 0, 0.0).otherwise(1.0), "digits": F.col("outcome").cast("double")}
    rows = place.select("doc_id", "start", "end", (F.col("outcome") == 1).alias("confirmed"), *[own.get(f, F.lit(1.0)).alias(f) for f in personal.FEATURES])
    rows = stage(rows, "proposals")
    h = F.xxhash64("doc_id", "start", "end", *personal.FEATURES)
    others = rows.where("kind = 1").orderBy(h).limit(25_000)
    late = rows.where((F.col("kind") == 0) & (h > F.lit(1 << 62)))
    assert others.agg(F.max(h)).first()[0] < 1 << 62 and late.count() > 1_000
    trees, limits = personal.fit(others.unionByName(late))
    assert set(limits) == {0, 1}
    assert trees.trees[0]._java_obj.rootNode().impurityStats().count() > 0.75 * (25_000 + late.count())
