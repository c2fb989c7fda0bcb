"""A transactions table derived from `lineitem`, and the small helpers of the registered queries."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwatch.config import ScoreColumns
from ledgerwatch.operators import model, slicing
from ledgerwatch.plans.names import Tables
from ledgerwatch.session import use_checkpoint_dir
from ledgerwatch.sources import sketches
from ledgerwatch.sources.tables import replace_table

FEATURES = ("V1", "V2", "V3", "Amount", "Hour")
EVENT_FEATURES = ("value", "Hour")
AUDIT = ("V1", "V2")
RUN_TS = "2024-01-15T03:00:00"
SCORE = ScoreColumns(score="score")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    seconds = (F.col("l_orderkey") * 7919 + F.col("l_partkey") * 104729 + F.col("l_suppkey") * 31 + F.col("l_linenumber") * 17) % 172800
    positive = (F.col("l_returnflag") == "R") & (F.col("l_discount") >= F.lit(0.08)) & (F.col("l_quantity") >= F.lit(46.0))
    mixed = F.lit(0.5) * (F.col("l_discount") / F.lit(0.1)) + F.lit(0.4) * (F.col("l_quantity") / F.lit(50.0))
    mixed = mixed + F.lit(0.1) * (F.col("l_extendedprice") / F.lit(110000.0))
    return line.select(
        seconds.cast("double").alias("Time"),
        F.col("l_quantity").alias("V1"),
        F.col("l_discount").alias("V2"),
        F.col("l_tax").alias("V3"),
        F.col("l_extendedprice").alias("Amount"),
        F.when(positive, 1).otherwise(0).cast("int").alias("Class"),
        (F.floor(mixed * F.lit(1000000.0) + F.lit(0.5)).cast("double") / F.lit(1000000.0)).alias("score"),
    )


def with_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slicing.add_hour(transactions(spark, sf_dir))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weak-signal case: error events against the rest."""
    raw = spark.read.parquet(f"{sf_dir}/events.parquet")
    return raw.select(
        "value",
        F.hour("ts").cast("long").alias("Hour"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).cast("int").alias("Class"),
    )


def sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slicing.assign_pseudo_day(with_hour(spark, sf_dir))


def scored(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Scoring, validation and training days of the stand-in score, under the names the operators expect."""
    named = stored(spark, sf_dir).withColumns(
        {"fraud_probability": F.col("score"), "predicted_Class": (F.col("score") >= F.lit(0.5)).cast("long")}
    )
    return slicing.split_by_day(named)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    doubles = {f.name: F.round(f.name, digits) for f in df.schema.fields if f.dataType.typeName() == "double"}
    return df.withColumns(doubles) if doubles else df


_work: dict[tuple[str, str], Tables] = {}
_models: dict[tuple[str, str, str], tuple] = {}


def work_tables(spark: SparkSession, name: str) -> Tables:
    """A fresh schema in the session's shared folder."""
    schema = f"lw_{name}_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{use_checkpoint_dir(spark)}/{schema}'")
    return Tables(schema)


def _tables(spark: SparkSession, sf_dir: str) -> Tables:
    """The sliced table, stored once per session and data set."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _work:
        tables = work_tables(spark, "sliced")
        replace_table(sliced(spark, sf_dir), tables["converted"], partition_by=("Date",))
        replace_table(sketches.sketches(spark.table(tables["converted"]), [*FEATURES, "score"]), tables["converted_sketches"])
        _work[key] = tables
    return _work[key]


def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(_tables(spark, sf_dir)["converted"])


def cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quantile sketches that are stored with the sliced table."""
    return spark.table(_tables(spark, sf_dir)["converted_sketches"])


def trained(spark: SparkSession, sf_dir: str, name: str = "model", **options) -> tuple:
    """(model, path), trained once per session and data set."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _models:
        days = slicing.split_by_day(stored(spark, sf_dir))
        path = f"{use_checkpoint_dir(spark)}/{name}_{uuid.uuid4().hex[:8]}"
        _models[key] = (model.train(days["training"], days["validation"], path, FEATURES, **options), path)
    return _models[key]


def trained_small(spark: SparkSession, sf_dir: str) -> tuple:
    return trained(spark, sf_dir, "small", max_iter=2, max_depth=2, n_bins=16)
