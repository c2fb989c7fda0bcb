"""The daily run: load one slice, score it, and replace the evaluation tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession

from ledgerwatch import config
from ledgerwatch.functions.columns import as_instant, stamp
from ledgerwatch.operators import drift, explain, history, model, scorecards, scores, separation, slicing
from ledgerwatch.plans.names import POOLED, WITH_HISTORY, Tables
from ledgerwatch.session import at_once, use_checkpoint_dir
from ledgerwatch.sources import sketches
from ledgerwatch.sources.tables import overwrite_slice, replace_table


def ingest_day(spark: SparkSession, tables: Tables, day: int) -> int:
    """Replace the batch table by one slice; only that partition of the sliced table is read."""
    slice_ = slicing.stored_day(spark.table(tables["converted"]), day).drop("Hour")
    return overwrite_slice(slice_, tables["batch"])


def snapshot_all(spark: SparkSession, tables: Tables) -> None:
    at_once(spark, *(partial(history.snapshot_history, spark, tables[name], tables.history(name)) for name in (*WITH_HISTORY, *POOLED)))


def score_batch(spark: SparkSession, tables: Tables, fitted: model.BoostedTrees) -> None:
    replace_table(slicing.add_hour(spark.table(tables["batch"])), tables["daily_converted"])
    replace_table(model.predict(fitted, spark.table(tables["daily_converted"])), tables["predictions"])


def store_sketches(spark: SparkSession, tables: Tables, features: Sequence[str]) -> None:
    """Quantile sketches of what the batch's metrics order: the features and the score. One pass, in place of a sample for each."""
    for source, columns in (("daily_converted", list(features)), ("predictions", ["fraud_probability"])):
        replace_table(sketches.sketches(spark.table(tables[source]), columns), tables[f"{source}_sketches"])


def evaluate_batch(
    spark: SparkSession,
    tables: Tables,
    fitted: model.BoostedTrees,
    run_ts: datetime | str,
    features: Sequence[str] = config.FEATURES,
    audit: Sequence[str] = config.AUDIT_FEATURES,
    tie_break: Sequence[str | Column] = config.SLICE_ORDER,
) -> None:
    """Write the daily figures, the nine evaluation tables, the retraining signal and the two scorecards; all but the signal have
    the same time stamp.

    Each table is read back from storage by those that build on it, so nothing is computed twice. Tables that do not build on one
    another are written side by side.
    """
    use_checkpoint_dir(spark)
    moment = as_instant(run_ts)

    def put(name: str, df: DataFrame) -> None:
        replace_table(stamp(df, moment), tables[name])

    def get(name: str) -> DataFrame:
        return spark.table(tables[name])

    transactions, predictions = get("daily_converted"), get("predictions")

    def separate() -> None:
        profile = separation.profile_features(transactions, features, cuts=get("daily_converted_sketches")).checkpoint()
        put("feature_separation", separation.feature_separation(transactions, features, profile=profile))
        put("woe_bins", separation.woe_bins_from(profile))

    def rank() -> None:
        rungs = scores.ladder(scores.scored(predictions), cuts=get("predictions_sketches"))
        at_once(
            spark,
            lambda: put("evaluation", scores.evaluate(predictions, area=scores.roc_auc(rungs))),
            lambda: put("cost_curve", scores.cost_curve(predictions)),
        )
        put("imbalance_metrics", scores.imbalance_metrics(predictions, curve=get("cost_curve"), ranking=scores.ranking_of(rungs)))

    def watch() -> None:
        at_once(
            spark,
            lambda: put("score_ladder", scores.score_ladder(predictions)),
            lambda: put("psi", drift.psi(get("baseline_histogram"), drift.score_histogram(predictions))),
        )
        store_signal(spark, tables)

    def explain_model() -> None:
        put("global_explain", explain.global_report(get("model_attributions"), audit))
        put("local_explain", explain.local_explain(predictions, get("global_explain"), fitted, tie_break=tie_break))

    def judge_features() -> None:
        card = scorecards.feature_matrix(get("feature_separation"), get("feature_importance"), get("global_explain"))
        replace_table(card, tables["feature_matrix"])

    def judge_model() -> None:
        names = ("evaluation", "imbalance_metrics", "psi", "feature_importance", "global_explain", "local_explain")
        replace_table(scorecards.evaluation_matrix(*(get(n) for n in names)), tables["evaluation_matrix"])

    at_once(
        spark,
        watch,
        separate,
        rank,
        explain_model,
        lambda: put("feature_importance", model.importance_report(get("model_importance"))),
        lambda: put("kpis", scores.daily_kpis(predictions)),
    )
    at_once(spark, judge_features, judge_model)


def whole_series(spark: SparkSession, tables: Tables, name: str) -> DataFrame:
    """All dates of an evaluation table: its history, if there is one yet, and today's rows."""
    current, past = spark.table(tables[name]), tables.history(name)
    return history.series(spark.table(past), current) if spark.catalog.tableExists(past) else current


def store_signal(spark: SparkSession, tables: Tables) -> None:
    """The retraining signal from the PSI and the scores of every date so far."""
    signal = history.retrain_trigger(whole_series(spark, tables, "psi"), whole_series(spark, tables, "score_ladder"))
    replace_table(signal, tables["retrain_signal"])


def run_daily(
    spark: SparkSession,
    tables: Tables,
    model_path: str,
    day: int | None = None,
    run_ts: datetime | str | None = None,
    features: Sequence[str] = config.FEATURES,
    audit: Sequence[str] = config.AUDIT_FEATURES,
    tie_break: Sequence[str | Column] = config.SLICE_ORDER,
) -> int:
    """One day's work; returns the rows loaded. Running a day again gives the same tables."""
    moment = as_instant(run_ts) if run_ts else datetime.now(timezone.utc)
    rows = ingest_day(spark, tables, day if day is not None else slicing.default_day(moment))

    def score() -> model.BoostedTrees:
        fitted = model.load(spark, model_path)
        score_batch(spark, tables, fitted)
        store_sketches(spark, tables, features)
        return fitted

    _, fitted = at_once(spark, lambda: snapshot_all(spark, tables), score)
    evaluate_batch(spark, tables, fitted, moment, features, audit, tie_break)
    return rows
