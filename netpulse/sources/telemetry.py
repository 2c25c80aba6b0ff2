"""Telemetry scans: CSV files, and the stand-in derived from an event log."""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from netpulse.operators.quality import require

RAW_SCHEMA = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("cell_id", T.StringType()),
    T.StructField("site_id", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("signal_strength_dbm", T.DoubleType()),
    T.StructField("sinr_db", T.DoubleType()),
    T.StructField("latency_ms", T.DoubleType()),
    T.StructField("packet_loss_pct", T.DoubleType()),
    T.StructField("throughput_mbps", T.DoubleType()),
    T.StructField("connected_users", T.IntegerType()),
    T.StructField("traffic_load_pct", T.DoubleType()),
    T.StructField("cpu_utilization_pct", T.DoubleType()),
    T.StructField("alarm_count", T.IntegerType()),
    T.StructField("failure_event", T.IntegerType()),
])


def read_telemetry_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType | None = RAW_SCHEMA, corrupt: str | None = None
) -> DataFrame:
    """CSV files with headers, columns matched by name; fields that do not parse become NULL.

    Every file's own header says where its columns are, so order and number may differ
    between files.  The result holds the columns of ``schema``, NULL where a file lacks
    one, and then every further column found, as text.  Whole-number columns accept
    ``120.0``.  With ``corrupt`` a column of that name holds the text of lines that have
    more or fewer fields than their header.  ``schema=None`` takes the first file's header and
    infers the types, at the price of an extra pass over the files.
    """
    if schema is None:
        return spark.read.option("header", True).option("mode", "PERMISSIVE").option("inferSchema", True).csv(path)
    layouts: dict[tuple[str, ...], list[str]] = {}
    for file, header in csv_headers(spark, [path] if isinstance(path, str) else path):
        layouts.setdefault(header, []).append(file)
    require(bool(layouts), f"no CSV file with a header under {path}")
    extras = sorted({name for header in layouts for name in header} - set(schema.fieldNames()))
    parts = [_named_columns(spark, files, header, schema, extras, corrupt) for header, files in layouts.items()]
    return reduce(DataFrame.unionByName, parts)


def csv_headers(spark: SparkSession, paths: list[str]) -> list[tuple[str, tuple[str, ...]]]:
    """(file, column names) of every non-empty file: the first line of each, read through the file system."""
    hadoop, conf = spark._jvm.org.apache.hadoop, spark._jsc.hadoopConfiguration()
    codecs = hadoop.io.compress.CompressionCodecFactory(conf)
    files, waiting = [], []
    for path in paths:
        place = hadoop.fs.Path(path)
        waiting += list(place.getFileSystem(conf).globStatus(place) or [])
    while waiting:
        status = waiting.pop()
        place = status.getPath()
        if status.isDirectory():
            waiting += [s for s in place.getFileSystem(conf).listStatus(place) if s.getPath().getName()[:1] not in "._"]
        else:
            files.append(place)

    def header(place) -> tuple[str, tuple[str, ...]] | None:
        stream = place.getFileSystem(conf).open(place)
        try:
            codec = codecs.getCodec(place)
            readable = codec.createInputStream(stream) if codec else stream
            line = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(readable, "UTF-8")).readLine()
        finally:
            stream.close()
        if not (line or "").strip():
            return None
        names = tuple(name.strip() for name in next(csv.reader([line.removeprefix("\ufeff")])))
        require(len(set(names)) == len(names), f"{place}: a column name repeats in {names}")
        return place.toString(), names

    with ThreadPoolExecutor(16) as pool:
        return sorted(found for found in pool.map(header, files) if found)


def _named_columns(
    spark: SparkSession, files: list[str], header: tuple[str, ...], schema: T.StructType, extras: list[str], corrupt: str | None
) -> DataFrame:
    """Files of one layout, read as text by position and then typed by name."""
    fields = [T.StructField(name, T.StringType()) for name in header]
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").option("enforceSchema", True)
    if corrupt:
        fields.append(T.StructField(corrupt, T.StringType()))
        reader = reader.option("columnNameOfCorruptRecord", corrupt)
    rows = reader.schema(T.StructType(fields)).csv(files)

    def typed(field: T.StructField) -> Column:
        if field.name not in header:
            return F.lit(None).cast(field.dataType).alias(field.name)
        text = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.IntegralType):
            number = F.trim(text).try_cast("double")
            return F.when(number == F.floor(number), number).try_cast(field.dataType).alias(field.name)
        return (F.trim(text) if isinstance(field.dataType, T.NumericType) else text).try_cast(field.dataType).alias(field.name)

    further = [(F.col(f"`{name}`") if name in header else F.lit(None).cast("string")).alias(name) for name in extras]
    return rows.select(*map(typed, schema), *further, *([corrupt] if corrupt else []))


def _null_every(period: int, value: Column) -> Column:
    return F.when(F.col("event_id") % period != 0, value)


def telemetry_from_events(events: DataFrame) -> DataFrame:
    """Deterministic raw telemetry over a whole event log, defects included.

    Every event becomes one observation, and every fiftieth also an exact copy
    of it, from a single scan.  The recipe is spelled out in ``FIXTURES.md``.
    """
    event = F.col("event_id")
    copies = F.explode(F.when(event % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    cell = F.col("user_id") % 10
    x, y, g, h = F.col("x"), F.col("y"), F.col("g"), F.hour("ts")
    pad = lambda number: F.lpad(number.cast("string"), 4, "0")
    region = (
        F.when(g.isin(0, 8), F.when(event % 3 == 0, " houston ").otherwise("HOUSTON"))
        .when(g == 2, F.when(event % 2 == 0, "Ft Worth").otherwise("fort worth "))
        .when(g == 4, F.when(event % 13 == 0, "dallas").otherwise("Dallas"))
        .otherwise(" Austin")
    )
    return (
        events.select("event_id", "ts", "user_id", "event_type", "value", copies.alias("copy"))
        .withColumns({
            "x": (event * 7919) % 1000,
            "y": (event * 104729) % 400,
            "c": cell,
            "g": cell - cell % 2,
        })
        .select(
            _null_every(211, F.col("ts")).alias("timestamp"),
            F.when(event % 307 == 0, "CELL_X").otherwise(F.concat(F.lit("CELL_"), pad(F.col("c")))).alias("cell_id"),
            _null_every(311, F.concat(F.lit("SITE_"), pad(g))).alias("site_id"),
            region.alias("region"),
            _null_every(89, (x % 60 - 110).cast("double")).alias("signal_strength_dbm"),
            _null_every(97, (y % 350).cast("double") / 10).alias("sinr_db"),
            _null_every(101, F.col("value") + 20).alias("latency_ms"),
            F.when(x < 900, x.cast("double") / 1000)
            .otherwise((x - 900).cast("double") / 20 + 1).alias("packet_loss_pct"),
            (((x * 7) % 5000).cast("double") / 10).alias("throughput_mbps"),
            ((x * 3) % 500 - 1).cast("int").alias("connected_users"),
            (F.lit(35.0) + (2 * (12 - F.abs(12 - h))).cast("double") + y.cast("double") / 8).alias("traffic_load_pct"),
            (F.lit(10.0) + ((x + y) % 920).cast("double") / 10).alias("cpu_utilization_pct"),
            (x % 10).cast("int").alias("alarm_count"),
            F.when((F.col("event_type") == "error") & (F.col("value") > 15), 1).otherwise(0).alias("failure_event"),
        )
    )


def read_event_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry_from_events(spark.read.parquet(f"{sf_dir}/events.parquet"))
