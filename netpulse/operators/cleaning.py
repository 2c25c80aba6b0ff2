"""Raw telemetry to the silver layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from netpulse import fixed
from netpulse import functions as fn
from netpulse.operators.ordering import exact_percentiles
from netpulse.session import stage


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """Whole-row distinct; copies collapse map-side before the shuffle."""
    return df.dropDuplicates()


def existing(df: DataFrame, columns: list[str]) -> list[str]:
    return [name for name in columns if name in df.columns]


def parse_timestamp(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """Text to timestamp; text that is no timestamp becomes NULL instead of an error."""
    if isinstance(df.schema[column].dataType, (T.TimestampType, T.TimestampNTZType)):
        return df
    return df.withColumn(column, F.try_to_timestamp(F.col(column).cast("string")))


def valid_rows(df: DataFrame) -> DataFrame:
    """Deduplicate, canonicalise regions, then keep rows that pass every check.

    The checks are plain column predicates, so Catalyst pushes them below the
    deduplicating shuffle: rejected rows are never exchanged.
    """
    return valid_distinct(drop_exact_duplicates(df))


def valid_distinct(distinct: DataFrame) -> DataFrame:
    """The same for rows that are distinct already."""
    return (
        parse_timestamp(distinct.withColumn("region", fn.standardize_region()))
        .filter(F.col("timestamp").isNotNull())
        .filter(fn.valid_cell_id() & fn.valid_site_id())
        .filter(fn.valid_kpi())
    )


def _present(df: DataFrame, column: str) -> Column:
    """The value with NaN read as missing, as the fill does."""
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return F.nanvl(F.col(column), F.lit(None))
    return F.col(column)


def medians(df: DataFrame, columns: list[str], accuracy: int | None = None) -> DataFrame:
    """One row of medians: observed values, NULL for a column without any.

    Exact by default.  With ``accuracy`` the rank may be off by ``n / accuracy``
    and one pass of mergeable sketches replaces three counting passes.
    """
    if accuracy is not None:
        return df.agg(*[
            F.percentile_approx(_present(df, name), F.lit(0.5), F.lit(accuracy)).alias(name) for name in columns
        ])
    found = exact_percentiles(df, columns, [0.5])
    return found.agg(*[
        F.max(F.when(F.col("column") == name, F.col("values")[0])).cast(df.schema[name].dataType).alias(name)
        for name in columns
    ])


def impute_median(df: DataFrame, columns: list[str] | None = None, accuracy: int | None = None) -> DataFrame:
    """Fill missing values of each existing column with that column's median.

    The medians are computed first (one row reaches the driver) and enter the
    plan as constants: pass a stored frame, or its lineage runs twice.
    """
    columns = existing(df, fixed.IMPUTED_COLUMNS if columns is None else columns)
    if not columns:
        return df
    median = medians(df, columns, accuracy).first()
    return df.withColumns({
        name: F.coalesce(_present(df, name), F.lit(median[name]).cast(df.schema[name].dataType)) for name in columns
    })


def add_features(df: DataFrame) -> DataFrame:
    """Calendar columns and operational flags, in one projection."""
    hour = F.hour("timestamp")
    return df.withColumns({
        "hour_of_day": hour,
        "day_of_week": fn.dow_name(),
        "event_date": F.to_date("timestamp"),
        "time_period": fn.time_period(hour),
        "high_load_flag": fn.flag(F.col("traffic_load_pct") >= fixed.HIGH_LOAD_PCT),
        "high_latency_flag": fn.flag(F.col("latency_ms") >= fixed.HIGH_LATENCY_MS),
        "packet_loss_flag": fn.flag(F.col("packet_loss_pct") >= fixed.HIGH_PACKET_LOSS_PCT),
        "network_health_flag": fn.network_health_flag(),
    })


def clean(raw: DataFrame) -> DataFrame:
    """Silver layer.

    The deduplicated valid rows are staged: the medians then read a few narrow
    columns of them, and the one wide shuffle is not repeated.
    """
    return finish_clean(valid_rows(raw))


def finish_clean(valid: DataFrame) -> DataFrame:
    return add_features(impute_median(stage(valid, "valid")))


def build_gold(silver: DataFrame) -> DataFrame:
    """Gold layer: a narrow projection, no shuffle."""
    return silver.select(
        *fixed.GOLD_COLUMNS,
        fn.severity_score().alias("operational_severity_score"),
        fn.operational_status().alias("operational_status"),
    )


def complete_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with no NULL or NaN among ``columns``, which are also the output columns."""
    return df.select(*columns).dropna(how="any")


def dedup_by_key(df: DataFrame, keys: list[str], best: list[str]) -> DataFrame:
    """One row per key: the one with the largest ``best`` tuple (missing values last).

    An aggregate rather than a row number, so the copies of a hot key are
    reduced before they are shuffled.  ``best`` must name every other column
    whose value is kept; further columns decide remaining ties by their value.
    """
    rest = [name for name in df.columns if name not in keys]
    ordered = best + [name for name in rest if name not in best]
    return (
        df.groupBy(*keys)
        .agg(F.max(F.struct(*ordered)).alias("kept"))
        .select(*keys, *[F.col(f"kept.{name}").alias(name) for name in rest])
    )


def head(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """First ``n`` rows of a total order."""
    return df.orderBy(*order).limit(n)


def ordered(df: DataFrame, *keys: str | Column) -> DataFrame:
    return df.orderBy(*keys)


def arg_max(df: DataFrame, by: str, *ties: str | Column) -> DataFrame:
    """The row with the largest ``by``."""
    return df.orderBy(F.col(by).desc_nulls_last(), *ties).limit(1)


def equal_to(column: str, value) -> Column:
    return F.col(column) == F.lit(value)


def is_alert(level: str = "risk_level") -> Column:
    return F.col(level).isin(fixed.ALERT_LEVELS)
