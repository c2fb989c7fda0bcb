"""Dated history of the evaluation tables, the time series over it, and the retraining signal."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwatch import config
from ledgerwatch.operators import scores
from ledgerwatch.sources.tables import quoted


ROWS, DATES = "__rows", "__dates"


def _prepare(spark: SparkSession, like: DataFrame, history: str) -> None:
    """The three parts of a history: its rows by date, the dates that are whole, and a view of the rows of those dates.

    A plain table of that name becomes the rows; all its dates count as whole.
    """
    rows, dates = history + ROWS, history + DATES
    plain = spark.catalog.tableExists(history) and spark.catalog.getTable(history).tableType != "VIEW"
    if plain:
        spark.table(history).select("evaluation_date").distinct().write.mode("overwrite").saveAsTable(dates)
        spark.sql(f"ALTER TABLE {quoted(history)} RENAME TO {quoted(rows.split('.', 1)[1])}")
        spark.sql(f"MSCK REPAIR TABLE {quoted(rows)} SYNC PARTITIONS")
    if not spark.catalog.tableExists(rows):
        like.limit(0).write.partitionBy("evaluation_date").saveAsTable(rows)
    if not spark.catalog.tableExists(dates):
        like.limit(0).select("evaluation_date").write.saveAsTable(dates)
    if not spark.catalog.tableExists(history):
        spark.sql(
            f"CREATE VIEW {quoted(history)} AS SELECT * FROM {quoted(rows)} WHERE evaluation_date IN (SELECT evaluation_date FROM {quoted(dates)})"
        )


def _replace_date(df: DataFrame, rows: str, day: date) -> None:
    """Put `df` in place of the partition of one date."""
    columns = [c for c in df.columns if c != "evaluation_date"]
    listed = ", ".join(f"`{c}`" for c in columns)
    insert = f"INSERT OVERWRITE TABLE {quoted(rows)} PARTITION (evaluation_date = DATE '{day}') SELECT {listed} FROM {{df}}"
    df.sparkSession.sql(insert, df=df)


def snapshot_history(spark: SparkSession, source: str, history: str) -> None:
    """Add the rows of `source` whose evaluation date the history does not have yet. Runs before `source` is replaced.

    The first copy of a date stays: a second run on the same day is not stored again. Rows are written into the partition of
    their date, replacing what an unfinished run left there, and the date is noted after that. Only noted dates are seen
    under the name `history`, so a run that ends anywhere can be repeated.
    """
    if not spark.catalog.tableExists(source):
        return
    current = spark.table(source)
    _prepare(spark, current, history)
    rows, dates = history + ROWS, history + DATES
    new = new_rows(current, spark.table(dates)).select(*spark.table(rows).columns)
    added = [r.evaluation_date for r in new.select("evaluation_date").distinct().collect()]
    if not added:
        return
    for day in added:  # a run has one date
        _replace_date(new.filter(F.col("evaluation_date") == F.lit(day)), rows, day)
    note = spark.createDataFrame([(d,) for d in added], "evaluation_date date")
    note.coalesce(1).write.mode("append").saveAsTable(dates)


def new_rows(rows: DataFrame, history: DataFrame) -> DataFrame:
    dates = history.select("evaluation_date").distinct()
    return rows.join(dates, "evaluation_date", "left_anti").select(*rows.columns)


def series(history: DataFrame, current: DataFrame) -> DataFrame:
    """History and today's table together. For a date that both have, today's rows win."""
    dates = current.select("evaluation_date").distinct()
    past = history.join(dates, "evaluation_date", "left_anti")
    return past.select(*current.columns).unionByName(current)


def retrain_trigger(psi_series: DataFrame, ladder_series: DataFrame) -> DataFrame:
    """Signals to retrain: PSI of a day at or above 0.25, or the month's PR-AUC below 0.80.

    `ladder_series` has the score ladders of all dates (`scores.score_ladder`). A month's PR-AUC is that of all its
    transactions together, as if they had been scored on one day.
    """
    daily = psi_series.groupBy("evaluation_date").agg(F.any_value("psi").alias("metric_value")).select(
        F.lit("psi_daily").alias("signal"),
        F.col("evaluation_date").alias("period"),
        "metric_value",
        F.lit(config.PSI_ALARM).alias("limit_value"),
        (F.col("metric_value") >= F.lit(config.PSI_ALARM)).alias("retrain"),
    )
    months = ladder_series.withColumn("period", F.trunc("evaluation_date", "month"))
    monthly = scores.pooled_ranking(months, ["period"]).select(
        F.lit("pr_auc_monthly").alias("signal"),
        "period",
        F.col("pr_auc").alias("metric_value"),
        F.lit(config.PR_AUC_PASS).alias("limit_value"),
        (F.col("pr_auc") < F.lit(config.PR_AUC_PASS)).alias("retrain"),
    )
    return daily.unionByName(monthly)
