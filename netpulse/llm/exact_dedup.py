"""Exact deduplication by content sort.

Splitters taken from a sample range-partition the normalised texts, Spark's
external sort places equal texts next to each other, and each row is compared in
full with its neighbour.  The sort order is (leading bytes, digest, id): the
digest separates long texts with equal beginnings, and the id lets a splitter
fall inside a group of equal texts, so that a group holding a third of all rows
is spread over many buckets.  Groups cut by a splitter are joined again from one
row per bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netpulse.llm.common import SPACES, documents_of, partitions, stage, unused

# Buckets per shuffle partition, sampled rows per bucket, leading bytes in a splitter.
BUCKETS_PER_PARTITION = 2
SAMPLES_PER_BUCKET = 8
LEADING_BYTES = 32
_GROUP_CHARS = 2 * LEADING_BYTES + 64


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def _group_key(norm: Column, digest: Column) -> Column:
    """Fixed-width text that equal contents share and that sorts by their leading bytes."""
    head = F.hex(F.substring(F.encode(norm, "UTF-8"), 1, LEADING_BYTES))
    return F.concat(F.rpad(head, 2 * LEADING_BYTES, " "), digest)


def _sortable_id(doc_id: Column) -> Column:
    """The id as fixed-width text in numeric order, a missing id last."""
    return F.coalesce(F.lpad(F.hex(doc_id.bitwiseXOR(F.lit(-(2**63)).cast("long"))), 16, "0"), F.lit("G" * 16))


def _splitters(keyed: DataFrame, buckets: int) -> list[str]:
    """Bucket borders from a sample; its size follows the number of buckets, not of rows."""
    rows = keyed.count()
    if rows == 0:
        return []
    wanted = SAMPLES_PER_BUCKET * buckets
    share = min(1.0, wanted / rows)
    sampled = keyed.sample(fraction=share, seed=7) if share < 1 else keyed
    found = sorted(r[0] for r in sampled.select("key").collect())
    step = max(1, len(found) // buckets)
    return sorted(set(found[step::step]))


def _bucket(key: Column, borders: list[str]) -> Column:
    """How many borders are at or below ``key``, looked up in two steps of about the square root each."""
    if not borders:
        return F.lit(0)
    width = max(1, round(len(borders) ** 0.5))
    blocks = [borders[i : i + width] for i in range(0, len(borders), width)]
    heads = F.split(F.lit(",".join(b[0] for b in blocks)), ",")
    bodies = F.transform(F.split(F.lit(";".join(",".join(b) for b in blocks)), ";"), lambda b: F.split(b, ","))
    block = F.size(F.filter(heads, lambda b: b <= key))
    inside = F.size(F.filter(F.get(bodies, block - 1), lambda b: b <= key))
    return F.when(block == 0, F.lit(0)).otherwise((block - 1) * width + inside)


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their normalised forms are; null counts as empty, and
    empty texts are equal to each other.  Of each group the row with the smallest
    doc_id is kept; missing ids come last, and of repeated rows with the same id
    exactly one is kept.  Other columns of ``docs`` are ignored.  Runs the sample,
    and stages one narrow row per document.
    """
    spark = docs.sparkSession
    norm = documents_of(docs).select("doc_id", normalised(F.col("text")).alias("norm"))
    shas = norm.withColumn("text_sha256", F.sha2(F.encode("norm", "UTF-8"), 256))
    keyed = shas.withColumn("key", F.concat(_group_key(F.col("norm"), F.col("text_sha256")), _sortable_id(F.col("doc_id"))))
    borders = _splitters(keyed, BUCKETS_PER_PARTITION * partitions(spark))

    bucketed = keyed.withColumn("bucket", _bucket(F.col("key"), borders))
    cut = F.lit(False)
    if borders:
        listed, group = F.split(F.lit(",".join(borders)), ","), F.substring("key", 1, _GROUP_CHARS)
        cut = F.coalesce(F.get(listed, F.col("bucket")).startswith(group), F.lit(False)) | F.coalesce(
            F.get(listed, F.col("bucket") - 1).startswith(group), F.lit(False)
        )
    bucketed = bucketed.withColumn("cut", cut).drop("key")

    sorted_rows = Window.partitionBy("bucket").orderBy("norm", F.col("doc_id").asc_nulls_last())
    compared = bucketed.select(
        "doc_id", "text_sha256", "bucket", "cut", F.row_number().over(sorted_rows).alias("pos"),
        "norm", F.lag("norm").over(sorted_rows).alias("before"),
    ).withColumn("head", F.col("before").isNull() | (F.col("before") != F.col("norm")))
    narrow = compared.select(
        "doc_id", "text_sha256", "bucket", "cut", "pos", "head",
        F.when(F.col("head") & F.col("cut"), F.col("norm")).alias("cut_text"),
    )
    so_far = Window.partitionBy("bucket").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    runs = narrow.select(
        "*", F.last(F.when(F.col("head"), F.struct(F.col("pos").alias("run"), F.col("doc_id").alias("id"))), ignorenulls=True).over(so_far).alias("first"),
    ).select("*", F.col("first.run").alias("run"), F.col("first.id").alias("run_id")).drop("first")
    rows = stage(runs.withColumn("run_size", F.count(F.lit(1)).over(Window.partitionBy("bucket", "run"))), "exact")

    # Groups that a border cuts: at most two runs a bucket, compared by their whole texts.
    same = Window.partitionBy("cut_text")
    order = F.struct(F.col("run_id").isNull().alias("missing"), "run_id", "bucket", "run")
    joined = (
        rows.where("head AND cut")
        .select("bucket", "run", F.min(order).over(same).alias("best"), F.sum("run_size").over(same).alias("whole_size"))
        .select("bucket", "run", "whole_size", F.col("best.run_id").alias("whole_id"),
                ((F.col("best.bucket") == F.col("bucket")) & (F.col("best.run") == F.col("run"))).alias("owner"))
    )
    return rows.join(F.broadcast(joined), ["bucket", "run"], "left").select(
        "doc_id",
        F.when(F.col("owner").isNull(), F.col("run_id")).otherwise(F.col("whole_id")).alias("keep_id"),
        F.coalesce("whole_size", "run_size").alias("group_size"),
        (F.col("head") & F.coalesce("owner", F.lit(True))).alias("kept"),
        "text_sha256",
    )


def _content(docs: DataFrame) -> Column:
    """A hash of all columns; missing values count, each in its own place."""
    parts = []
    for field in docs.schema:
        column = F.col(f"`{field.name}`")
        shown = column.cast("string") if "map<" in field.dataType.simpleString() else column
        parts += [column.isNull(), shown]
    return F.xxhash64(*parts)


def without_exact_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``exact_duplicates`` keeps, all columns as they were, whatever their names.

    Null texts count as empty.  Of rows that repeat both doc_id and text, the one with
    the least hash of all columns stays: the same for any partitioning.
    """
    def key(doc_id: Column, digest: Column) -> Column:
        return F.concat_ws(":", F.coalesce(doc_id.cast("long").cast("string"), F.lit("none")), digest)

    name, place = unused(docs, "row_key"), unused(docs, "row_place")
    kept = exact_duplicates(docs).where("kept").select(key(F.col("doc_id"), F.col("text_sha256")).alias(name))
    keyed = docs.withColumn(name, key(F.col("doc_id"), F.sha2(F.encode(normalised(F.col("text")), "UTF-8"), 256)))
    # only the first place is asked for, so each task passes on one row a key
    repeat = Window.partitionBy(name).orderBy(_content(docs))
    found = keyed.join(kept, name, "left_semi").withColumn(place, F.row_number().over(repeat))
    return found.where(F.col(place) == 1).select(*(F.col(f"`{c}`") for c in docs.columns))
