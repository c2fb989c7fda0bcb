"""First set-up: copy the source, slice it into days, train, and store what depends on the model alone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from ledgerwatch import config
from ledgerwatch.operators import drift, explain, model, slicing
from ledgerwatch.plans.names import Tables
from ledgerwatch.session import at_once
from ledgerwatch.sources.tables import copy_source, replace_table


def build_slices(spark: SparkSession, tables: Tables, order: Sequence[str] = config.SLICE_ORDER) -> None:
    """Store the sliced table by `Date`, so that every later slice or range of days is a partition filter."""
    sliced = slicing.assign_pseudo_day(slicing.add_hour(spark.table(tables["public"])), order=order)
    replace_table(sliced, tables["converted"], partition_by=("Date",))
    for name, days in (("validation", config.VALIDATION_DAYS), ("train", config.TRAINING_DAYS)):
        spark.sql(
            f"CREATE OR REPLACE VIEW {tables[name]} AS SELECT * FROM {tables['converted']} "
            f"WHERE Date BETWEEN {days[0]} AND {days[1]}"
        )


def store_model_facts(spark: SparkSession, tables: Tables, fitted: model.BoostedTrees, path: str) -> None:
    """Facts that change only with the model: score histogram of the training days, importances, global attributions."""

    def attribute() -> None:
        attributed = explain.with_attributions(spark.table(tables["validation"]), fitted)
        replace_table(explain.global_attributions(attributed, fitted.features), tables["model_attributions"])

    def histogram() -> None:
        baseline = drift.score_histogram(model.score(fitted, spark.table(tables["train"])))
        replace_table(baseline, tables["baseline_histogram"])

    importance = model.raw_importance(model.tree_nodes(spark, path), fitted.features)
    at_once(spark, attribute, histogram, lambda: replace_table(importance, tables["model_importance"]))


def set_up(
    spark: SparkSession,
    source: str,
    tables: Tables,
    model_path: str,
    features: Sequence[str] = config.FEATURES,
    order: Sequence[str] = config.SLICE_ORDER,
    **training,
) -> model.BoostedTrees:
    copy_source(spark, source, tables["public"])
    build_slices(spark, tables, order)
    fitted = model.train(
        spark.table(tables["train"]), spark.table(tables["validation"]), model_path, features, **training
    )
    store_model_facts(spark, tables, fitted, model_path)
    return fitted
