"""Managed tables: whole-table overwrite, read back, verify; small CSV reports."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from netpulse.operators.quality import require

FORECAST_SCHEMA = T.StructType([
    T.StructField("forecast_timestamp", T.TimestampType(), False),
    T.StructField("predicted_traffic_load_pct", T.DoubleType()),
    T.StructField("forecast_lower_pct", T.DoubleType()),
    T.StructField("forecast_upper_pct", T.DoubleType()),
    T.StructField("capacity_risk", T.StringType()),
])

EXPORT_SCHEMA = T.StructType([
    T.StructField("forecast_timestamp", T.TimestampType(), False),
    T.StructField("predicted_traffic_load_pct", T.DoubleType()),
    T.StructField("forecast_lower_bound", T.DoubleType()),
    T.StructField("forecast_upper_bound", T.DoubleType()),
])


@lru_cache(maxsize=1)
def _delta_installed() -> bool:
    try:
        import delta  # noqa: F401
    except ImportError:
        return False
    return True


def table_format(spark: SparkSession) -> str:
    """Delta where the session is set up for it, Parquet otherwise."""
    extensions = spark.conf.get("spark.sql.extensions", None) or ""
    return "delta" if _delta_installed() and "delta" in extensions.lower() else "parquet"


def read_layer(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def conform(df: DataFrame, schema: T.StructType, what: str = "frame") -> DataFrame:
    """``df`` in the columns and order of ``schema``, matched by name.

    Missing, additional and differently typed columns are refused at once; a NULL in a
    column that must not hold one fails the job that computes it, without another pass.
    """
    offered = {f.name: f.dataType for f in df.schema}
    expected = {f.name: f.dataType for f in schema}
    require(offered.keys() == expected.keys(), f"{what} must hold the columns {list(expected)}; got {list(offered)}")
    wrong = [f"{n} is {offered[n].simpleString()}, not {t.simpleString()}" for n, t in expected.items() if offered[n] != t]
    require(not wrong, f"{what}: {'; '.join(wrong)}")

    def column(field: T.StructField):
        if field.nullable:
            return F.col(field.name)
        refused = F.raise_error(F.lit(f"{what}: {field.name} must not be NULL")).cast(field.dataType)
        return F.when(F.col(field.name).isNull(), refused).otherwise(F.col(field.name)).alias(field.name)

    return df.select(*map(column, schema))


def write_layer(
    df: DataFrame, name: str, replace_schema: bool = True, partition_by: list[str] | None = None,
    schema: T.StructType | None = None,
) -> int:
    """Overwrite a managed table; returns the rows that the write itself counted.

    With ``schema`` the frame must conform to it, on the first write too.  With
    ``replace_schema=False`` an existing table keeps its columns: they are matched by
    name, and a frame with others is refused instead of replacing them.  Partitioned
    writes are rebalanced first: busy partitions are split over several tasks
    and quiet ones share one, so neither stragglers nor tiny files appear.
    """
    spark = df.sparkSession
    if schema is not None:
        df = conform(df, schema, name)
    if not replace_schema and spark.catalog.tableExists(name):
        df = conform(df, spark.table(name).schema, f"{name} keeps its schema and")
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    written = Observation()
    writer = df.observe(written, F.count(F.lit(1)).alias("rows")).write.format(table_format(spark)).mode("overwrite")
    if replace_schema:
        writer = writer.option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    return written.get.get("rows", 0)


def verify_saved(spark: SparkSession, name: str, expected: int) -> int:
    """Row count of the saved table, refused when it is not the expected one."""
    saved = spark.table(name).count()
    require(saved == expected, f"{name} holds {saved} rows, expected {expected}")
    return saved


def export_csv(df: DataFrame, path: str) -> None:
    """One CSV file with a header.

    The frame is computed in parallel and then streamed by one writing task; results of
    many rows belong in a table.
    """
    df.repartition(1).write.mode("overwrite").option("header", "true").csv(path)


def read_forecast(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name).select(*FORECAST_SCHEMA.fieldNames())
