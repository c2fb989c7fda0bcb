import numpy as np
import pytest

from ledgerwatch.operators import drift


def frame(spark, values):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "fraud_probability double")


def test_equal_scores_are_green(spark):
    scores = frame(spark, np.linspace(0, 1, 200))
    rows = drift.psi_of_scores(scores, scores).collect()
    assert len(rows) == 10 and {r.psi_rating for r in rows} == {"Green"} and rows[0].psi == pytest.approx(0.0)
    assert drift.psi_by_edges(scores, scores).first().psi_rating == "Green"


def test_definition_with_floor(spark):
    old, new = [0.05] * 6 + [0.95] * 4, [0.05] * 9 + [1.0]
    rows = {r.bin_id: r for r in drift.psi_of_scores(frame(spark, old), frame(spark, new + [None])).collect()}
    assert rows[0].baseline_pct == pytest.approx(0.6) and rows[0].daily_pct == pytest.approx(0.9)
    assert rows[9].daily_pct == pytest.approx(0.1) and rows[5].baseline_pct == rows[5].daily_pct == 0.0001
    want = 0.3 * np.log(0.9 / 0.6) + (0.1 - 0.4) * np.log(0.1 / 0.4)
    assert rows[3].psi == pytest.approx(want) and rows[3].psi_rating == "Red"


def test_one_empty_side_gives_no_rows(spark):
    full, empty = frame(spark, [0.1, 0.2]), frame(spark, [None]).filter("fraud_probability IS NOT NULL")
    assert drift.psi_of_scores(full, empty).count() == 0
    assert drift.psi_of_scores(empty, full).count() == 0


def test_scores_on_an_edge(spark):
    rows = {r.bin_id: r.n for r in drift.score_histogram(frame(spark, [0.3, 0.0, 1.0])).collect()}
    assert rows == {3: 1, 0: 1, 9: 1}


@pytest.mark.parametrize("low,high", [(0, 1), (-0.2, 1.3)])
def test_edges_variant_equals_histogram(spark, low, high):
    rng = np.random.default_rng(0)
    old, new = rng.uniform(low, high, 500), np.r_[rng.beta(2, 5, 300), np.arange(11) / 10]
    edges = np.linspace(0, 1, 11)
    share = [np.maximum(np.histogram(np.clip(x, 0, 1), edges)[0] / len(x), 1e-4) for x in (old, new)]
    want = np.sum((share[1] - share[0]) * np.log(share[1] / share[0]))
    got = drift.psi_by_edges(frame(spark, [*old, np.nan]), frame(spark, [*new, np.inf])).first()
    assert got.psi == pytest.approx(want)


def test_scores_that_are_no_numbers_are_left_out(spark):
    rows = [(0.05,), (0.95,), (float("nan"),), (float("inf"),), (None,)]
    got = {r.bin_id: r.n for r in drift.score_histogram(spark.createDataFrame(rows, "fraud_probability double")).collect()}
    assert got == {0: 1, 9: 1}
