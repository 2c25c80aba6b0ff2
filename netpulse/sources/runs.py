"""Model artifacts and the run table that tracks parameters and metrics."""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T

from netpulse.operators.boosting import BoostedTrees

RUNS_TABLE = "model_runs"

RUN_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("run_name", T.StringType(), False),
    T.StructField("start_time", T.TimestampType(), False),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("artifacts", T.MapType(T.StringType(), T.StringType())),
])

EXAMPLE_ROWS = 5


def save_model(model: PipelineModel | BoostedTrees, path: str) -> str:
    if isinstance(model, BoostedTrees):
        model.save(SparkSession.active(), path)
    else:
        model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel | BoostedTrees:
    spark = SparkSession.active()
    trees = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/trees")
    if trees.getFileSystem(spark._jsc.hadoopConfiguration()).exists(trees):
        return BoostedTrees.load(spark, path)
    return PipelineModel.load(path)


def model_signature(train: DataFrame, features: list[str], label: str) -> str:
    """Input and output columns with their types, as JSON."""
    types = dict(train.dtypes)
    return json.dumps({"inputs": {name: types[name] for name in features}, "output": {label: types[label]}})


def input_example(train: DataFrame, features: list[str], order: list[str]) -> str:
    """The first few training inputs, as JSON rows."""
    rows = train.orderBy(*order).select(*features).limit(EXAMPLE_ROWS).toJSON().collect()
    return json.dumps([json.loads(row) for row in rows])


def log_run(
    spark: SparkSession,
    name: str,
    params: dict,
    metrics: dict,
    artifacts: dict[str, str] | None = None,
    table: str = RUNS_TABLE,
) -> str:
    """Append one run; returns its id."""
    run_id = uuid.uuid4().hex
    row = Row(
        run_id=run_id,
        run_name=name,
        start_time=datetime.now(timezone.utc),
        params={key: str(value) for key, value in params.items()},
        metrics={key: None if value is None else float(value) for key, value in metrics.items()},
        artifacts=dict(artifacts or {}),
    )
    spark.createDataFrame([row], RUN_SCHEMA).write.mode("append").saveAsTable(table)
    return run_id


def latest_run(spark: SparkSession, name: str, table: str = RUNS_TABLE) -> Row:
    """Newest run of that name; an error when the table or the run is missing."""
    if not spark.catalog.tableExists(table):
        raise ValueError(f"run table {table} not found: train and log a model first")
    found = (
        spark.table(table).filter(F.col("run_name") == name)
        .orderBy(F.desc("start_time"), F.desc("run_id")).limit(1).collect()
    )
    if not found:
        raise ValueError(f"no run named {name} in {table}")
    return found[0]
