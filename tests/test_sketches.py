"""Stored quantile sketches: they merge over any groups, and results do not depend on them."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerwatch.operators import ordering, scores, separation
from ledgerwatch.sources import sketches


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(2)
    rows = [(int(d), float(p), float(a), int(c), None if n else float(v)) for d, p, a, c, n, v in zip(
        rng.integers(1, 6, 4000), np.round(rng.beta(1, 9, 4000), 3), rng.integers(1, 90, 4000), rng.random(4000) < 0.1, rng.random(4000) < 0.1, rng.normal(size=4000))]
    return spark.createDataFrame(rows, "Date int, fraud_probability double, Amount double, Class int, V1 double").repartition(6).checkpoint()


def test_points_of_merged_groups_are_quantiles_of_the_rows(spark, table):
    stored = sketches.sketches(table.withColumn("empty", F.lit(None).cast("double")), ["V1", "Amount", "empty"])
    assert stored.count() == 10 and stored.columns == ["Date", "column", "sketch"]
    for days, rows in ((stored, table), (stored.filter("Date <= 2"), table.filter("Date <= 2"))):
        got = sketches.points(days, ["V1", "Amount", "empty", "none"], 20)
        assert sorted(got) == ["Amount", "V1"]
        values = np.sort([r.V1 for r in rows.filter("V1 IS NOT NULL").collect()])
        ranks = np.searchsorted(values, got["V1"]) / len(values)
        assert np.abs(ranks - np.arange(1, 20) / 20).max() < 0.02


@pytest.mark.parametrize("source", ["same", "other", "none"])
def test_results_do_not_depend_on_the_sketches(spark, table, source):
    """Also not where they belong to other data, or know nothing of the column."""
    data = {"same": table, "other": table.withColumns({"fraud_probability": F.lit(0.5), "V1": F.col("V1") * 100}), "none": table.limit(0)}[source]
    cuts = sketches.sketches(data, ["fraud_probability", "V1", "Amount"])
    plain = scores.ranking_metrics(scores.scored(table)).first()
    got = scores.ranking_metrics(scores.scored(table), cuts).first()
    assert got.asDict() == {k: pytest.approx(v) if isinstance(v, float) else v for k, v in plain.asDict().items()}
    assert scores.evaluate(table, cuts=cuts).first().roc_auc == pytest.approx(scores.evaluate(table).first().roc_auc)
    want = {r.feature: r for r in separation.feature_separation(table, ["V1", "Amount"]).collect()}
    for r in separation.feature_separation(table, ["V1", "Amount"], cuts=cuts).collect():
        assert r.asDict() == {k: pytest.approx(v) if isinstance(v, float) else v for k, v in want[r.feature].asDict().items()}


def test_no_sample_is_read_with_sketches(table, monkeypatch):
    cuts = sketches.sketches(table, ["fraud_probability", "V1"]).checkpoint()
    monkeypatch.setattr(ordering, "quantiles", lambda *a, **b: pytest.fail("a sample was read"))
    thin = table.withColumn("fraud_probability", F.col("fraud_probability") + F.rand(1))
    assert scores.pr_auc(thin, cuts=sketches.sketches(thin, ["fraud_probability"])).count() == 1
    assert separation.ks_statistic is not None and separation.feature_separation(table, ["V1"], cuts=cuts).count() == 1
