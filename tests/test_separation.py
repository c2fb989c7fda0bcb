import math
import time
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

import reference_math as brute
from ledgerwatch.operators import ordering, separation


def frame(spark, pos, neg, name="x"):
    rows = [(1, float(v)) for v in pos] + [(0, float(v)) for v in neg]
    return spark.createDataFrame(rows, f"Class int, {name} double").repartition(5)


def report(spark, pos, neg):
    return separation.feature_report(frame(spark, pos, neg), ["x"]).first()


def test_identical_samples_do_not_separate(spark):
    values = np.random.default_rng(0).normal(size=400)
    row = report(spark, values, values)
    assert row.ks_statistic < 0.20 and abs(row.cliffs_delta) < 0.147
    assert row.ks_rating == "分離能不足" and not row.is_strong_separator


def test_complete_separation(spark):
    row = report(spark, [4.0] * 80, [0.0] * 200)
    assert row.ks_statistic >= 0.99 and row.cliffs_delta >= 0.99 and row.information_value >= 0.30
    assert (row.ks_rating, row.cliffs_rating, row.is_strong_separator) == ("卓越", "Large", True)
    assert row.skewness_fraud is None and row.kurtosis_fraud is None


def test_small_cases_by_hand(spark):
    assert separation.ks_statistic(frame(spark, [1, 2, 3, 10], [0, 1, 1.5, 2]), ["x"]).first().ks_statistic == pytest.approx(0.5)
    row = separation.cliffs_delta(frame(spark, [1, 1, 4, 5], [0, 1, 2, 2, 3]), ["x"]).first()
    assert row.cliffs_delta == pytest.approx(0.3, abs=1e-12)


def test_delta_sign(spark):
    up = separation.cliffs_delta(frame(spark, [5, 6, 7], [0, 1, 2]), ["x"]).first().cliffs_delta
    down = separation.cliffs_delta(frame(spark, [0, 1, 2], [5, 6, 7]), ["x"]).first().cliffs_delta
    assert up > 0.9 and down < -0.9


def test_no_signal_has_low_iv(spark):
    shared = np.random.default_rng(1).normal(size=300)
    row = separation.information_value(frame(spark, shared[:50], shared[50:]), ["x"], mode="floor").first()
    assert row.information_value < 0.30


def test_missing_and_infinite_values_are_dropped(spark):
    row = report(spark, [5, 6, -math.inf, 7], [0, 1, math.nan, math.inf])
    assert math.isfinite(row.ks_statistic) and row.cliffs_delta == pytest.approx(1.0)


def test_one_class_only_is_absent(spark):
    df = spark.createDataFrame([(1, 1.0, None), (0, 2.0, 3.0), (0, 2.5, 4.0)], "Class int, a double, b double")
    assert [r.feature for r in separation.feature_separation(df, ["a", "b"]).collect()] == ["a"]


@pytest.mark.parametrize("mode", ["ntile", "floor"])
@pytest.mark.parametrize("shape", ["unique", "ties", "hot", "few", "tiny"])
def test_profile_equals_row_by_row(spark, mode, shape):
    rng = np.random.default_rng(5)
    pos, neg = {
        "unique": (rng.normal(0.5, 1, 150), rng.normal(0, 1, 900)),
        "ties": (rng.integers(0, 40, 151) / 4, rng.integers(0, 50, 802) / 4),
        "hot": (np.r_[np.zeros(70), rng.normal(1, 1, 80)], np.r_[np.zeros(400), rng.normal(0, 1, 600)]),
        "few": (rng.integers(0, 3, 60), rng.integers(0, 4, 300)),
        "tiny": ([1.0, 2.0], [0.0, 1.0, 2.0]),
    }[shape]
    pos, neg = np.asarray(pos, float), np.asarray(neg, float)
    df = frame(spark, pos, neg)
    profile = separation.profile_features(df, ["x"], mode=mode)
    got = separation.with_woe(profile).orderBy("bin_id").collect()
    want = brute.bins(pos, neg, 10, mode)
    assert [(r.bin_id, r.bin_min, r.bin_max, r.n_rows, r.n_pos) for r in got] == [w[:5] for w in want]
    assert [r.iv_contribution for r in got] == pytest.approx([w[5] for w in want])
    row = separation.rank_metrics(profile).first()
    assert row.ks_statistic == pytest.approx(brute.ks(pos, neg))
    assert row.cliffs_delta == pytest.approx(brute.delta(pos, neg), abs=1e-12)


def test_signed_zeros_are_one_value(spark):
    row = separation.ks_statistic(frame(spark, [0.0, -0.0, 0.0], [-0.0, 0.0]), ["x"]).first()
    assert row.ks_statistic == 0.0


def test_features_with_and_without_ties_together(spark):
    rng = np.random.default_rng(3)
    n = 1200
    label, smooth, tied = rng.integers(0, 2, n), rng.normal(size=n), rng.integers(0, 5, n).astype(float)
    rows = list(zip(label.tolist(), smooth.tolist(), tied.tolist()))
    df = spark.createDataFrame(rows, "Class int, smooth double, tied double")
    got = {r.feature: r for r in separation.feature_separation(df, ["smooth", "tied"]).collect()}
    for name, x in (("smooth", smooth), ("tied", tied)):
        pos, neg = x[label == 1], x[label == 0]
        assert got[name].ks_statistic == pytest.approx(brute.ks(pos, neg))
        assert got[name].z_score_diff == pytest.approx((pos.mean() - neg.mean()) / (neg.std() + 1e-9))


def test_thirty_features_in_one_plan(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(300, 30))
    label = (x[:, 14] + rng.normal(size=300) > 1).astype(int)
    names = [f"V{i + 1}" for i in range(28)] + ["Amount", "Hour"]
    rows = [(int(c), *map(float, r)) for c, r in zip(label, x)]
    df = spark.createDataFrame(rows, "Class int, " + ", ".join(f"{n} double" for n in names))
    got = {r.feature: r.ks_statistic for r in separation.feature_separation(df).collect()}
    assert set(got) == set(names)
    assert got["V15"] == pytest.approx(brute.ks(x[label == 1, 14], x[label == 0, 14]))


def test_sampled_delta(spark):
    rng = np.random.default_rng(2)
    pos, neg = rng.normal(2, 1, 600), rng.normal(0, 1, 1200)
    df = frame(spark, pos, neg)
    first = separation.sampled_cliffs_delta(df, ["x"], max_pos=500, max_neg=1000).first().cliffs_delta
    again = separation.sampled_cliffs_delta(df.repartition(3), ["x"], max_pos=500, max_neg=1000).first().cliffs_delta
    assert first == again and first == pytest.approx(brute.delta(pos, neg), abs=0.05)
    assert separation.sampled_cliffs_delta(df, ["x"]).first().cliffs_delta == pytest.approx(brute.delta(pos, neg), abs=1e-12)


def test_a_large_sample_is_not_sorted_in_one_task(spark):
    df = spark.range(100).select(F.col("id").alias("Class"), F.rand(1).alias("x"))
    plan = separation.sampled_cliffs_delta(df, ["x"], max_pos=5000, max_neg=5000)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "row_number" in line]
    assert any("share" in line for line in windows)


@pytest.mark.parametrize("present", [0, 20])
def test_floor_bins_count_each_features_own_values(spark, present):
    df = spark.range(20000).select(
        (F.col("id") % 3 == 0).cast("int").alias("Class"),
        F.rand(3).alias("a"),
        F.when(F.col("id") < present, F.col("id").cast("double")).alias("b"),
    )
    got = {r.feature: r for r in separation.feature_report(df, ["a", "b"]).collect()}
    assert len(got["a"].woe_bins) == 10
    assert ("b" in got) == (present > 0)
    if present:
        assert len(got["b"].woe_bins) == 10


def test_many_bins(spark):
    df = spark.range(5000).select((F.col("id") % 7 == 0).cast("int").alias("Class"), F.rand(5).alias("x"))
    assert separation.profile_features(df, ["x"], n_bins=200, mode="floor").count() == 200


def test_sampled_delta_with_missing_values_uses_the_first_rows_of_each_feature(spark):
    rng = np.random.default_rng(4)
    rows = [
        (int(rng.integers(0, 2)), float(i), float(rng.normal()), None if rng.random() < 0.7 else float(rng.normal()))
        for i in range(900)
    ]
    df = spark.createDataFrame(rows, "Class int, id double, a double, b double").repartition(4)
    got = separation.sampled_cliffs_delta(df, ["a", "b"], draw=F.col("id"), max_pos=40, max_neg=60).collect()
    for r in got:
        at = 2 if r.feature == "a" else 3
        known = sorted((row[1], row[0], row[at]) for row in rows if row[at] is not None)
        pos = [v for _, c, v in known if c == 1][:40]
        neg = [v for _, c, v in known if c == 0][:60]
        assert r.cliffs_delta == pytest.approx(brute.delta(pos, neg), abs=1e-12)


def test_unpivot_drops_missing(spark):
    df = spark.createDataFrame([(1, 1.0, None), (0, math.nan, 2.0)], "Class int, a double, b double")
    rows = {tuple(r) for r in separation.unpivot_features(df, ["a", "b"]).collect()}
    assert rows == {(1, "a", 1.0), (0, "b", 2.0)}


def test_tied_counts_are_shuffled_once_and_untied_rows_are_not_combined_first(spark):
    rng = np.random.default_rng(8)
    plans = {}
    for kind, values in (("untied", rng.normal(size=30000)), ("tied", rng.integers(0, 9, 30000))):
        counts = separation.value_counts(frame(spark, values[:900], values[900:]), ["x"])
        counts.collect()
        plans[kind] = counts._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in plans["tied"] and "passthrough" in plans["tied"]
    assert "passthrough" in plans["untied"]
    by_value = [line for line in plans["untied"].split("\n") if "hashpartitioning(" in line and "value" in line.split("hashpartitioning")[1]]
    assert not by_value


def test_cut_points_isolate_frequent_values():
    points = [0.0] * 128 + [float(i) for i in range(1, 128)]
    cuts = ordering.cut_points(points, 32)
    assert cuts.hot == (0.0,) and cuts.tied
    assert math.nextafter(0.0, 1.0) in cuts.splits
    smooth = ordering.cut_points([float(i) for i in range(255)], 32)
    assert not smooth.tied and len(smooth.splits) == 33


def enumerated_pvalue(gap, m, n):
    """Share of all orders of m and n values in which the distance reaches the bound."""
    hits = total = 0
    for places in combinations(range(m + n), m):
        i = j = 0
        reached = False
        for t in range(m + n):
            i, j = (i + 1, j) if t in places else (i, j + 1)
            reached = reached or abs(i * n - j * m) >= gap
        hits, total = hits + reached, total + 1
    return hits / total


@pytest.mark.parametrize("m, n", [(1, 1), (1, 5), (3, 4), (4, 4), (5, 6), (2, 9)])
def test_exact_pvalue_equals_enumeration(m, n):
    for gap in range(m * n + 2):
        assert separation.exact_pvalue(gap, m, n) == pytest.approx(enumerated_pvalue(gap, m, n), abs=1e-12), gap
        assert separation.exact_pvalue(gap, n, m) == separation.exact_pvalue(gap, m, n)


def test_exact_pvalue_keeps_small_values_and_nears_the_limit():
    full = separation.exact_pvalue(60 * 60, 60, 60)
    assert full == pytest.approx(2 / math.comb(120, 60), rel=1e-9)
    scaled = 0.05 * math.sqrt(2000 * 3000 / 5000)
    limit = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * scaled * scaled) for k in range(1, 50))
    assert separation.exact_pvalue(round(0.05 * 2000 * 3000), 2000, 3000) == pytest.approx(limit, abs=0.01)


def test_report_with_exact_pvalues(spark):
    rows = [(0, v) for v in (0.0, 1.0, 1.5, 2.0)] + [(1, v) for v in (1.0, 2.0, 3.0, 10.0)]
    df = spark.createDataFrame([(c, v) for c, v in rows], "Class int, x double")
    got = separation.feature_report(df, ["x"], pvalue="exact").first()
    assert got.ks_statistic == 0.5 and got.ks_pvalue == pytest.approx(enumerated_pvalue(8, 4, 4))
    with pytest.raises(ValueError):
        separation.feature_report(df, ["x"], pvalue="other")


def test_exact_pvalue_of_clear_separation_needs_no_walk():
    """Chances below the least positive double are 0 at once; a walk of these sizes takes minutes."""
    begin = time.monotonic()
    assert separation.exact_pvalue(round(0.9 * 5000 * 5_000_000), 5000, 5_000_000) == 0.0
    assert time.monotonic() - begin < 1
    m, n = 900, 1500
    cut = round((m + n) * ((separation.LEAST_LOG + math.log(2 * (m + n))) * m / 2) ** 0.5)
    assert separation.exact_pvalue(cut + 1, m, n) == 0.0
    assert 0.0 < separation.exact_pvalue(round(0.7 * cut), m, n) < 1e-150


def test_exact_pvalues_have_a_task_per_feature(spark):
    rows = [(float(i), float(-i), float(i % 3), int(i > 4)) for i in range(8)]
    df = spark.createDataFrame(rows, "a double, b double, c double, Class int")
    report = separation.feature_report(df, ["a", "b", "c"], pvalue="exact")
    places = report.select("feature", "ks_pvalue", F.spark_partition_id().alias("task")).collect()
    assert len({r.task for r in places}) == len(places) == 3
