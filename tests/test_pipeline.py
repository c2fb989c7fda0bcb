"""First set-up and daily runs, end to end, on a small table with the full set of features."""

import threading
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerwatch import config
from ledgerwatch.operators import history
from ledgerwatch.plans import daily, initial
from ledgerwatch.plans.names import WITH_HISTORY, Tables
from ledgerwatch.session import at_once
from ledgerwatch.sources.tables import TRANSACTIONS


@pytest.fixture(scope="module")
def installed(spark, tmp_path_factory):
    schema = f"p_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE SCHEMA {schema}")
    tables = Tables(schema)
    rng = np.random.default_rng(3)
    n = 5000
    label = (rng.random(n) < 0.08).astype(int)
    v = rng.normal(size=(n, 28))
    for shift, name in ((-4, 14), (-3, 17), (-2, 12)):
        v[:, name - 1] += shift * label
    rows = [
        (float(t), *map(float, x), float(a), int(c))
        for t, x, a, c in zip(rng.integers(0, 172800, n), v, np.round(rng.gamma(1, 90, n), 2), label)
    ]
    source = str(tmp_path_factory.mktemp("source") / "transactions")
    spark.createDataFrame(rows, TRANSACTIONS).write.parquet(source)
    path = str(tmp_path_factory.mktemp("model") / "gbt")
    initial.set_up(spark, source, tables, path, max_iter=5, max_depth=3)
    for day, run_ts in ((3, "2024-05-03T00:00:00"), (4, "2024-05-04T00:00:00"), (4, "2024-05-04T06:00:00")):
        daily.run_daily(spark, tables, path, day, run_ts)
    return tables


def test_batch_is_one_slice(spark, installed):
    batch = spark.table(installed["batch"])
    assert batch.count() == 100 and [r.Date for r in batch.select("Date").distinct().collect()] == [4]
    assert "Hour" not in batch.columns and "Hour" in spark.table(installed["daily_converted"]).columns


def test_ranges(spark, installed):
    days = {n: spark.table(installed[n]).agg(F.min("Date"), F.max("Date")).first() for n in ("train", "validation")}
    assert tuple(days["train"]) == config.TRAINING_DAYS and tuple(days["validation"]) == config.VALIDATION_DAYS


def test_every_evaluation_table_has_one_stamp_and_a_history(spark, installed):
    for name in WITH_HISTORY:
        now, past = spark.table(installed[name]), spark.table(installed.history(name))
        assert now.count() > 0, name
        assert [str(r[0]) for r in now.select("evaluated_at").distinct().collect()] == ["2024-05-04 06:00:00"], name
        dates = sorted(str(r[0]) for r in past.select("evaluation_date").distinct().collect())
        assert dates == ["2024-05-03", "2024-05-04"], name
        series = history.series(past, now).select("evaluation_date", "evaluated_at").distinct()
        assert series.count() == 2, name


def test_daily_figures_and_the_retraining_signal(spark, installed):
    kpis = spark.table(installed["kpis"]).first()
    assert kpis.transactions == spark.table(installed["predictions"]).count()
    signal = spark.table(installed["retrain_signal"])
    daily_psi = signal.filter("signal = 'psi_daily'").collect()
    assert [str(r.period) for r in sorted(daily_psi, key=lambda r: r.period)] == ["2024-05-03", "2024-05-04"]
    today = spark.table(installed["psi"]).first().psi
    assert [r.metric_value for r in daily_psi if str(r.period) == "2024-05-04"] == [today]
    assert signal.filter("signal = 'pr_auc_monthly'").count() == 1


def test_scorecards(spark, installed):
    card = spark.table(installed["evaluation_matrix"]).orderBy("sort_order").collect()
    assert [r.sort_order for r in card] == list(range(1, 14))
    by_name = {r.metric_name: r for r in card}
    assert {r.category_id for r in card} == {2, 3, 4}
    assert by_name["audit_vars_in_shap_top5"].metric_value == 3.0 and by_name["audit_vars_in_shap_top5"].rating == "監査OK"
    assert by_name["roc_auc"].metric_value > 0.9 and by_name["psi"].threshold_warn == 0.25
    features = spark.table(installed["feature_matrix"])
    assert {r.metric_name: r.n for r in features.groupBy("metric_name").agg(F.count("*").alias("n")).collect()} == {
        "ks_statistic": 30,
        "information_value": 30,
        "cliffs_delta": 30,
        "z_score_diff": 30,
        "importance_gain": 30,
        "importance_cover": 30,
        "mean_abs_shap": 30,
    }
    strong = spark.table(installed["feature_separation"]).filter("is_strong_separator")
    assert {"V14", "V17", "V12"} <= {r.feature for r in strong.collect()}  # a slice of 100 rows also shows chance


def test_a_missing_audit_variable_counts_as_passed(spark, installed):
    from ledgerwatch.operators import scorecards

    tables = [spark.table(installed[n]) for n in ("evaluation", "imbalance_metrics", "psi", "feature_importance", "global_explain", "local_explain")]
    tables[4] = tables[4].withColumn("is_audit_variable", F.lit(False))
    row = scorecards.evaluation_matrix(*tables).filter("sort_order = 8").first()
    assert row.metric_value == 0.0 and row.rating == "監査OK" and row.is_pass


def test_steps_that_do_not_need_one_another_run_side_by_side(spark):
    met = threading.Barrier(2, timeout=30)
    assert at_once(spark, lambda: met.wait() >= 0, lambda: met.wait() >= 0, lambda: spark.range(3).count()) == [True, True, 3]
    done = []
    with pytest.raises(ZeroDivisionError):
        at_once(spark, lambda: 1 // 0, lambda: done.append(spark.range(5).count()))
    assert done == [5]
