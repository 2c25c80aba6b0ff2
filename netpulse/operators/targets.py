"""Will this cell fail soon?  Targets, chronological split and class balance.

A window over a whole cell would put a busy cell's entire history into one task.
Histories are therefore sorted once by (cell, time) into slices of about equal
size, wherever cells and seconds begin; each slice is scanned on its own, and a
small summary per (cell, slice) carries over what comes after the slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from netpulse import fixed
from netpulse.operators.cleaning import complete_rows
from netpulse.operators.ordering import OFFSET, SLICE, first_rows, stage_in_order

TARGET = "failure_next_30m"

# Decide the order of observations a cell reports for the same instant.
OBSERVATION_TIES = ["latency_ms", "throughput_mbps", "packet_loss_pct", "traffic_load_pct", "cpu_utilization_pct"]


def _failing() -> Column:
    return F.col("failure_event") == 1


def _earlier_slices() -> Window:
    """A cell's slices before the present one: slices run from late to early, so these come after it in time."""
    return Window.partitionBy("cell_id").orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)


def _earlier_in_slice() -> Window:
    return Window.partitionBy(SLICE, "cell_id").orderBy(OFFSET).rowsBetween(Window.unboundedPreceding, -1)


def _latest_first(df: DataFrame, ties: list[str]) -> list[Column]:
    """Cells, each from its last observation to its first; every other column breaks ties."""
    rest = [c for c in df.columns if c not in ("cell_id", "timestamp", *ties)]
    return [F.col("cell_id"), *[F.col(c).desc_nulls_last() for c in ("timestamp", *ties, *sorted(rest))]]


def future_failure_rows(
    df: DataFrame, n: int = fixed.ROWS_AHEAD, name: str = TARGET, ties: list[str] | None = None,
) -> DataFrame:
    """1 when any of the cell's next ``n`` observations fails, else 0; NULL after the last one.

    Observations are counted from the end of the cell's history, so the
    distance to the next failing one is a difference of two positions.  Those of
    one instant follow each other by ``ties``, then by the other columns.
    """
    ties = [c for c in OBSERVATION_TIES if c in df.columns] if ties is None else ties
    placed = stage_in_order(df, *_latest_first(df, ties))
    slices = placed.groupBy("cell_id", SLICE).agg(
        F.count(F.lit(1)).alias("size"), F.min(OFFSET).alias("first"),
        F.max(F.when(_failing(), F.col(OFFSET))).alias("failing"),
    )
    after = slices.withColumn("rows_after", F.coalesce(F.sum("size").over(_earlier_slices()), F.lit(0))).select(
        F.col("cell_id").alias("of"), F.col(SLICE).alias("at"), "first", "rows_after",
        F.last(F.col("rows_after") + F.col("failing") - F.col("first"), ignorenulls=True).over(_earlier_slices()).alias("failing_after"),
    )
    seen = placed.withColumn("__failing", F.last(F.when(_failing(), F.col(OFFSET)), ignorenulls=True).over(_earlier_in_slice()))
    position = F.col("rows_after") + F.col(OFFSET) - F.col("first")  # 0: the cell's last observation
    next_failing = F.coalesce(F.col("rows_after") + F.col("__failing") - F.col("first"), F.col("failing_after"))
    soon = F.coalesce(position - next_failing <= n, F.lit(False))
    joined = seen.join(after, F.col("cell_id").eqNullSafe(F.col("of")) & (F.col(SLICE) == F.col("at")))
    return joined.select(*df.columns, F.when(position > 0, soon.cast("int")).alias(name))


def future_failure_range(df: DataFrame, sec: int = fixed.SECONDS_AHEAD, name: str = TARGET) -> DataFrame:
    """1 when the cell fails within the next 1..``sec`` seconds, else 0; NULL when nothing is observed then.

    Only the next observed and the next failing second matter, so a cell's seconds are
    reduced to one row each before they are sorted: a hot second does no harm, and
    observations of the same second do not see each other.
    """
    second = F.unix_timestamp("timestamp")
    seconds = (
        df.where(F.col("timestamp").isNotNull()).groupBy("cell_id", second.alias("second"))
        .agg(F.coalesce(F.max(_failing()), F.lit(False)).alias("failing"))
    )
    placed = stage_in_order(seconds, F.col("cell_id"), F.col("second").desc())
    slices = placed.groupBy("cell_id", SLICE).agg(
        F.min("second").alias("first_second"), F.min(F.when(F.col("failing"), F.col("second"))).alias("first_failing"),
    )
    after = slices.select(
        F.col("cell_id").alias("of"), F.col(SLICE).alias("at"),
        F.last("first_second").over(_earlier_slices()).alias("second_after"),
        F.last("first_failing", ignorenulls=True).over(_earlier_slices()).alias("failing_after"),
    )
    seen = placed.withColumns({
        "later_second": F.last("second").over(_earlier_in_slice()),
        "later_failing": F.last(F.when(F.col("failing"), F.col("second")), ignorenulls=True).over(_earlier_in_slice()),
    })
    next_seen = F.coalesce("later_second", "second_after") - F.col("second")
    next_failing = F.coalesce("later_failing", "failing_after") - F.col("second")
    soon = F.coalesce(next_failing <= sec, F.lit(False))
    known = seen.join(after, F.col("cell_id").eqNullSafe(F.col("of")) & (F.col(SLICE) == F.col("at"))).select(
        F.col("cell_id").alias("__cell"), F.col("second").alias("__second"), F.when(next_seen <= sec, soon.cast("int")).alias(name)
    )
    return df.join(known, df["cell_id"].eqNullSafe(known["__cell"]) & (second == F.col("__second")), "left").select(*df.columns, name)


def rows_model_frame(gold: DataFrame, n: int = fixed.ROWS_AHEAD) -> DataFrame:
    """Complete rows of cells that are not failing now, with the next-observations target.

    The failing rows are removed after the target is known: they are what
    the target looks for.
    """
    known = future_failure_rows(gold, n).filter(F.col(TARGET).isNotNull() & (F.col("failure_event") == 0))
    return complete_rows(known, ["timestamp", "cell_id", *fixed.ROWS_MODEL_FEATURES, TARGET])


def range_model_frame(silver: DataFrame, sec: int = fixed.SECONDS_AHEAD) -> DataFrame:
    """Complete rows, failing ones included, with the next-seconds target."""
    known = future_failure_range(silver, sec).filter(F.col(TARGET).isNotNull())
    return complete_rows(known, ["timestamp", "cell_id", TARGET, *fixed.MODEL_FEATURES])


def time_split(df: DataFrame, frac: float = fixed.TRAIN_FRACTION, ties: list[str] | None = None) -> DataFrame:
    """Mark the first ``int(frac * n)`` rows by (timestamp, cell_id, ties) as train, the rest as test."""
    first = first_rows(df, int(df.count() * frac), "timestamp", ["cell_id", *(ties or _tie_columns(df))])
    return df.withColumn("split", F.when(first, "train").otherwise("test"))


def _tie_columns(df: DataFrame) -> list[str]:
    return [name for name in df.columns if name not in ("timestamp", "cell_id")]


def train_part(split: DataFrame) -> DataFrame:
    return split.filter(F.col("split") == "train").drop("split")


def test_part(split: DataFrame) -> DataFrame:
    return split.filter(F.col("split") == "test").drop("split")


def split_summary(split: DataFrame, label: str = TARGET) -> DataFrame:
    return split.groupBy("split", label).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("timestamp").alias("first_timestamp"), F.max("timestamp").alias("last_timestamp"),
    )


def pos_weight(train: DataFrame, label: str = TARGET) -> DataFrame:
    """Negatives, positives and their ratio (a train set without positives counts as one)."""
    counts = train.agg(
        F.coalesce(F.sum(F.when(F.col(label) == 0, 1)), F.lit(0)).alias("negatives"),
        F.coalesce(F.sum(F.when(F.col(label) == 1, 1)), F.lit(0)).alias("positives"),
    )
    return counts.withColumn(
        "scale_pos_weight", F.col("negatives").cast("double") / F.greatest("positives", F.lit(1)).cast("double")
    )


def target_summary(df: DataFrame, label: str = TARGET) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(label), F.lit(0)).cast("bigint").alias("positives"),
        F.avg(label).alias("base_rate"),
    )
