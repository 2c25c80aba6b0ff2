"""Profiling, the cleaning funnel and contract checks."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F

from netpulse import fixed
from netpulse import functions as fn
from netpulse.operators import cleaning
from netpulse.operators.ordering import exact_percentiles
from netpulse.operators.sampling import DIGEST, with_digest


def require(condition: bool, message: str) -> None:
    """Raise when an output contract is broken."""
    if not condition:
        raise ValueError(message)


def _count_if(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0)).cast("bigint")


def _null_count(name: str) -> Column:
    return F.sum(F.when(F.col(name).isNull(), 1).otherwise(0)).cast("bigint")


def copy_counts(df: DataFrame) -> DataFrame:
    """Distinct rows with the number of copies of each (``copies``)."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("copies"))


def extra_copies(df: DataFrame) -> DataFrame:
    """One row, ``extra``: the rows beyond the first of every set of equal rows.

    Two levels: 128-bit digests of all rows are counted first, which shuffles 16 bytes a
    row; only rows whose digest repeats are then compared as a whole.
    """
    named = with_digest(df)
    repeated = named.groupBy(*DIGEST).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 1).select(*DIGEST)
    suspects = named.join(repeated, DIGEST).select(*df.columns)
    return copy_counts(suspects).agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("extra"))


def _with_extra_copies(df: DataFrame, *totals: Column) -> DataFrame:
    """One row of ``totals`` over ``df`` (each at least 0) and ``extra``."""
    counted = df.agg(*totals).withColumn("extra", F.lit(0).cast("bigint"))
    none = [F.lit(0).cast("bigint").alias(name) for name in counted.columns[:-1]]
    both = counted.unionByName(extra_copies(df).select(*none, "extra"))
    return both.agg(*[F.sum(name).alias(name) for name in counted.columns])


def shape_profile(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows",
        F.lit(len(df.columns)).alias("columns"),
        F.lit(", ".join(df.columns)).alias("column_names"),
    )


def schema_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, nullability."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema)]
    return df.sparkSession.createDataFrame(rows, "position int, name string, type string, nullable boolean")


def missing_profile(df: DataFrame) -> DataFrame:
    return df.agg(*[_null_count(name).alias(name) for name in df.columns])


def total_missing(df: DataFrame) -> DataFrame:
    counts = missing_profile(df)
    return counts.select(
        reduce(add, [F.coalesce(F.col(name), F.lit(0)) for name in df.columns]).alias("total_missing")
    )


def duplicate_profile(df: DataFrame) -> DataFrame:
    """Rows, distinct rows and exact duplicates."""
    return _with_extra_copies(df, F.count(F.lit(1)).alias("total_rows")).select(
        "total_rows", (F.col("total_rows") - F.col("extra")).alias("distinct_rows"), F.col("extra").alias("exact_duplicates")
    )


def region_profile(df: DataFrame) -> DataFrame:
    return df.groupBy("region").agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "region")


def label_profile(df: DataFrame, column: str = "failure_event") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count")).orderBy(column)


def failure_rate(df: DataFrame, column: str = "failure_event") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("rows"), _count_if(F.col(column) == 1).alias("failures")
    ).withColumn(
        "failure_rate_pct", F.try_divide(F.col("failures").cast("double"), F.col("rows").cast("double")) * 100.0
    )


def entity_profile(df: DataFrame) -> DataFrame:
    """Distinct cells and sites, a missing id counting as one more value.

    Reduced to the id pairs first, so the two distinct counts do not multiply
    the input rows.
    """
    pairs = df.groupBy("cell_id", "site_id").agg(F.count(F.lit(1)).alias("rows"))
    plus_missing = lambda name: F.countDistinct(name) + F.max(F.col(name).isNull().cast("int"))
    return pairs.agg(plus_missing("cell_id").alias("unique_cells"), plus_missing("site_id").alias("unique_sites"))


def kpi_summary(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles: one row per existing KPI."""
    columns = cleaning.existing(df, fixed.KPI_COLUMNS if columns is None else columns)

    def moments(name: str) -> Column:
        value = F.col(name).cast("double")
        return F.struct(
            F.lit(name).alias("kpi"), F.count(value).alias("count"), F.avg(value).alias("mean"),
            F.stddev_samp(value).alias("stddev"), F.min(value).alias("min"), F.max(value).alias("max"),
        )

    rows = df.agg(F.array(*[moments(name) for name in columns]).alias("kpis")).select(F.inline("kpis"))
    quartiles = exact_percentiles(df, columns, [0.25, 0.5, 0.75]).select(
        F.col("column").alias("kpi"), *[F.col("values")[i].alias(name) for i, name in enumerate(["p25", "p50", "p75"])]
    )
    return rows.join(F.broadcast(quartiles), "kpi", "left").select(
        "kpi", "count", "mean", "stddev", "min", "p25", "p50", "p75", "max"
    )


def quality_funnel(raw: DataFrame) -> DataFrame:
    """What each cleaning step removes, from one deduplicating aggregation."""
    return funnel_of(copy_counts(raw))


def funnel_of(counted: DataFrame) -> DataFrame:
    """The funnel of distinct rows with their ``copies``.

    Every count is over the rows that survive the earlier steps.  ``null_kpi``
    holds rows whose validity is undecided for a missing input: they are
    neither invalid nor kept, and without them the funnel would not add up.
    """
    rows = cleaning.parse_timestamp(counted)
    dated = F.col("timestamp").isNotNull()
    cell, site, kpi = fn.valid_cell_id(), fn.valid_site_id(), fn.valid_kpi()
    identified = dated & cell & site
    return rows.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("raw_rows"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicates_removed"),
        _count_if(~dated).alias("invalid_timestamps"),
        _count_if(dated & ~cell).alias("invalid_cell_ids"),
        _count_if(dated & ~site).alias("invalid_site_ids"),
        _count_if(identified & ~kpi).alias("invalid_kpis"),
        _count_if(identified & kpi.isNull()).alias("null_kpi"),
        _count_if(identified & kpi).alias("final_rows"),
    )


def quality_gate(df: DataFrame, saved_rows: int | Column) -> DataFrame:
    """PASS when nothing is missing, nothing is duplicated and every row was saved."""
    saved = saved_rows if isinstance(saved_rows, Column) else F.lit(saved_rows).cast("bigint")
    missing = reduce(add, [F.when(F.col(name).isNull(), 1).otherwise(0) for name in df.columns])
    counts = _with_extra_copies(
        df, F.coalesce(F.sum(missing), F.lit(0)).alias("total_missing"), F.count(F.lit(1)).alias("final_rows")
    ).withColumnRenamed("extra", "remaining_duplicates").withColumn("saved_rows", saved)
    passed = (
        (F.col("total_missing") == 0) & (F.col("remaining_duplicates") == 0)
        & (F.col("saved_rows") == F.col("final_rows"))
    )
    return counts.select(
        "total_missing", "remaining_duplicates", "final_rows", "saved_rows", F.when(passed, "PASS").otherwise("REVIEW").alias("status")
    )
