import math
import numpy as np
import pytest
from pyspark.sql import functions as F

import reference_math as brute
from ledgerwatch.operators import scores

SCHEMA = "Class int, Amount double, fraud_probability double"


def scored(spark, rows):
    return spark.createDataFrame([(int(c), float(a), None if p is None else float(p)) for p, a, c in rows], SCHEMA).repartition(4)


def make(shape, n=3000, seed=7):
    rng = np.random.default_rng(seed)
    label = (rng.random(n) < 0.1).astype(int)
    score = np.clip(rng.beta(2, 8, n) + 0.25 * label, 0, 1)
    amount = np.round(rng.gamma(1, 80, n), 2)
    if shape == "ties":
        score, amount = np.round(score, 1), np.round(amount, -1)
    elif shape == "hot_score":
        score = np.where(rng.random(n) < 0.4, 0.25, score)
    elif shape == "hot_pair":
        hot = rng.random(n) < 0.4
        score, amount = np.where(hot, 0.25, score), np.where(hot, 9.99, amount)
    return list(zip(score.tolist(), amount.tolist(), label.tolist()))


@pytest.mark.parametrize("shape", ["smooth", "ties", "hot_score", "hot_pair"])
def test_ranking_metrics_equal_row_by_row(spark, shape):
    rows = make(shape)
    got = scores.ranking_metrics(scores.scored(scored(spark, rows))).first()
    assert got.pr_auc == pytest.approx(brute.average_precision(rows), abs=1e-12)
    ordered = sorted(rows, key=lambda r: (-r[0], r[1], r[2]))
    n_pos = sum(r[2] for r in rows)
    for k, rate in ((got.k_0_1, got.capture_rate_0_1pct), (got.k_0_5, got.capture_rate_0_5pct)):
        assert rate == pytest.approx(sum(r[2] for r in ordered[:k]) / n_pos)
    assert (got.n_rows, got.n_pos, got.k_0_1, got.k_0_5) == (3000, n_pos, 3, 15)


@pytest.mark.parametrize("tp,fp,n", [(0, 0, 5000), (0, 3, 1001), (17, 100000, 4000), (10**6, 5, 2500), (3, 10**9, 3000)])
def test_large_groups_use_the_closed_form(spark, tp, fp, n):
    df = spark.createDataFrame([(tp, fp, n)], "tp long, fp long, n long")
    got = df.select(scores.precision_sum(F.col("tp"), F.col("fp"), F.col("n")).alias("s")).first().s
    j = np.arange(1, n + 1, dtype=float)
    assert got == pytest.approx(float(np.sum((tp + j) / (tp + j + fp))), rel=1e-11, abs=1e-9)


def test_cost_curve_equals_definition(spark):
    rows = make("ties") + [(i / 100, 10.0, i % 2) for i in range(101)]
    curve = {round(r.threshold, 2): r for r in scores.cost_curve(scored(spark, rows)).collect()}
    assert len(curve) == 99
    losses = {}
    for i in range(1, 100):
        t = i / 100
        r = curve[t]
        fn = [a + 15 for p, a, c in rows if p < t and c]
        fp = sum(1 for p, _, c in rows if p >= t and not c)
        tp = sum(1 for p, _, c in rows if p >= t and c)
        tn = sum(1 for p, _, c in rows if p < t and not c)
        assert (r.tp_count, r.fn_count, r.fp_count, r.tn_count) == (tp, len(fn), fp, tn)
        losses[t] = sum(fn) + 5 * fp + 0.1 * tp
        assert r.expected_loss == pytest.approx(losses[t])
    best = scores.optimal_threshold(scores.cost_curve(scored(spark, rows))).first()
    assert best.min_expected_loss == pytest.approx(min(losses.values()))
    assert curve[best.optimal_threshold].is_optimal_threshold


def test_equal_losses_flag_all_and_pick_the_smallest(spark):
    df = scored(spark, [(0.995, 1.0, 1)])
    assert scores.cost_curve(df).filter("is_optimal_threshold").count() == 99
    assert scores.optimal_threshold(scores.cost_curve(df)).first().optimal_threshold == 0.01


def test_no_positives(spark):
    row = scores.imbalance_metrics(scored(spark, [(0.2, 1.0, 0), (0.4, 2.0, 0)])).first()
    assert row.n_pos == 0 and row.pr_auc == 0.0 and row.capture_rate_0_1pct is None
    assert {row.pr_auc_rating, row.capture_0_1_rating, row.capture_0_5_rating} == {"データ不足"}


def test_no_predictions_give_no_rows(spark):
    empty = scored(spark, [(None, 1.0, 1)])
    assert scores.imbalance_metrics(empty).count() == 0
    assert scores.cost_curve(empty).count() == 0


def test_missing_scores_are_left_out(spark):
    rows = make("smooth", 500)
    with_gaps = scores.imbalance_metrics(scored(spark, rows + [(None, 5.0, 1)] * 7)).first()
    assert with_gaps == scores.imbalance_metrics(scored(spark, rows)).first()


def test_evaluate(spark):
    rows = make("ties", 800)
    got = scores.evaluate(scored(spark, rows)).first()
    pos, neg = [p for p, _, c in rows if c], [p for p, _, c in rows if not c]
    tp, fp = sum(p >= 0.5 for p in pos), sum(p >= 0.5 for p in neg)
    assert got.precision == pytest.approx(tp / (tp + fp)) and got.recall == pytest.approx(tp / len(pos))
    assert got.f1_score == pytest.approx(2 * tp / (len(pos) + tp + fp))
    assert got.roc_auc == pytest.approx((brute.delta(np.array(pos), np.array(neg)) + 1) / 2)


def test_daily_kpis(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (1,), (0,)], "predicted_Class int")
    assert tuple(scores.daily_kpis(df).first()) == (5, 2, 40.0)


def test_rows_without_a_label_do_not_count(spark):
    rows = [(1, 1.0, 0.9), (0, 1.0, 0.1), (None, 1.0, 0.9)]
    got = scores.evaluate(spark.createDataFrame(rows, "Class int, Amount double, fraud_probability double")).first()
    assert got.log_loss == pytest.approx(-math.log(0.9)) and got.accuracy == 1.0


def random_scores(spark, n, levels, seed):
    rng = np.random.default_rng(seed)
    rows = [(int(d), float(p), float(a), None if c == 2 else int(c)) for d, p, a, c in zip(rng.integers(1, 4, n), rng.integers(0, levels, n) / levels, rng.integers(0, 5, n), rng.choice([0, 1, 2], n, p=[0.6, 0.3, 0.1]))]
    return spark.createDataFrame(rows, "Date int, fraud_probability double, Amount double, Class int").repartition(5)


def auc(rows):
    pos, neg = ([r.fraud_probability for r in rows if r.Class == c] for c in (1, 0))
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg)) if pos and neg else None


@pytest.mark.parametrize("n, levels", [(400, 3), (400, 1), (300, 1000), (6000, 4)])
def test_roc_auc_from_the_order(spark, n, levels):
    df = random_scores(spark, n, levels, levels)
    rungs = scores.ladder(scores.scored(df))
    assert levels > 4 or rungs.hot  # frequent scores lie in several cells
    assert scores.roc_auc(rungs).first().roc_auc == pytest.approx(auc(df.collect()))
    by = scores.roc_auc(scores.ladder(scores.scored(df, by=["Date"]), ["Date"]))
    for r in by.collect():
        assert r.roc_auc == pytest.approx(auc(df.filter(F.col("Date") == r.Date).collect()))


def test_roc_auc_without_one_class(spark):
    df = random_scores(spark, 50, 10, 1).filter("Class = 0")
    assert scores.roc_auc(scores.ladder(scores.scored(df))).first().roc_auc is None
    assert scores.evaluate(df).first().roc_auc is None


@pytest.mark.parametrize("levels", [3, 500])
def test_all_days_at_once_equal_single_days(spark, levels):
    df = random_scores(spark, 900, levels, 7)
    together = {r.Date: r for r in scores.metrics_by(df).collect()}
    assert sorted(together) == [1, 2, 3]
    for day, got in together.items():
        one = df.filter(F.col("Date") == day)
        for want in (scores.imbalance_metrics(one).first(), scores.evaluate(one).first()):
            for name, value in want.asDict().items():
                assert got[name] == (pytest.approx(value) if isinstance(value, float) else value), name


def test_pooled_ladders_equal_single_rows(spark):
    df = random_scores(spark, 700, 40, 3)
    stored = scores.score_ladder(df, by=["Date"])
    assert stored.count() < df.count()
    want, got = scores.ranking_metrics(scores.scored(df)).first(), scores.pooled_ranking(stored).first()
    assert got.asDict() == {k: pytest.approx(v) if isinstance(v, float) else v for k, v in want.asDict().items()}
