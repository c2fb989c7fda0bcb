"""How well each feature separates positives from negatives: KS, Cliff's delta, z difference, IV and WoE bins.

All rank-based metrics come from one *profile* with at most `n_bins` rows per feature. It is built from value
counts, so equal values travel once, and it never sorts single rows or compares pairs.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ledgerwatch import config
from ledgerwatch.functions import ratings
from ledgerwatch.functions.columns import clean_double, count_where, is_finite
from ledgerwatch.operators import ordering
from ledgerwatch.sources import sketches

KS_SERIES_TERMS = 100
# exp(-LEAST_LOG) is less than half the least positive double.
LEAST_LOG = 746.0


def unpivot_features(df: DataFrame, features: Sequence[str] = config.FEATURES, label: str = "Class") -> DataFrame:
    """Wide to long: (class_label, feature_name, feature_value), without missing and non-finite values."""
    typed = df.select(F.col(label).cast("long").alias("class_label"), *[clean_double(f).alias(f) for f in features])
    long = typed.unpivot("class_label", list(features), "feature_name", "feature_value")
    return long.filter(is_finite(F.col("feature_value")))


def _name(features: Sequence[str]) -> Column:
    return F.element_at(F.array(*[F.lit(f) for f in features]), F.col("fid") + 1).alias("feature")


def value_counts(
    df: DataFrame, features: Sequence[str] = config.FEATURES, label: str = "Class", cuts: DataFrame | None = None
) -> DataFrame:
    """One row per (feature, value) with class counts, the counts before it, and the feature totals.

    `all_n_values` is the exact number of distinct values of the feature.

    Features travel as a number. Values get their cell while the table is still wide, then one generator makes it long.
    Features with frequent values and features without them are counted in their own way (see `count_equal`); each
    part reads only its own columns. Cut points come from `cuts`, the stored sketches of the table, or else from a sample that is
    read while the plan is built.
    """
    names = [f"v{i}" for i in range(len(features))]

    def finite_values(rows: DataFrame) -> DataFrame:
        clean = [clean_double(f).alias(v) for f, v in zip(features, names)]
        wide = rows.select(F.col(label).cast("long").alias("label"), *clean)
        return wide.select("label", *[F.when(is_finite(F.col(v)), F.col(v)).alias(v) for v in names])

    finite = finite_values(df)
    n_cells = ordering.target_cells(df.sparkSession, len(features))
    if cuts is None:
        found = ordering.quantiles(df, names, n_cells, finite_values)
    else:
        stored = sketches.points(cuts, features, ordering.n_points(n_cells))
        found = {v: stored.get(f) for v, f in zip(names, features)}
    cuts = {v: ordering.cut_points(found[v], n_cells) for v in names}
    measures = {
        "n_pos": count_where(F.col("label") == 1),
        "n_neg": count_where(F.col("label") == 0),
        "n_all": F.count(F.lit(1)),
    }
    result = None
    for tied in (False, True):
        chosen = [i for i, v in enumerate(names) if cuts[v].tied == tied]
        if not chosen:
            continue
        splits = {names[i]: list(cuts[names[i]].splits) for i in chosen}
        celled = ordering.bucketize(finite.select("label", *splits), splits, {v: f"c{v}" for v in splits})
        parts = [part for i in chosen for part in (F.lit(i), F.col(names[i]), F.col(f"c{names[i]}"))]
        long = celled.select("label", F.stack(F.lit(len(chosen)), *parts).alias("fid", "value", "cell"))
        # All three are spelled out so that both readings of the counts have the same filter and share one shuffle.
        long = long.filter(F.col("value").isNotNull() & F.col("fid").isNotNull() & F.col("cell").isNotNull())
        turn = F.col("fid") * F.lit(n_cells) + F.col("cell")
        long = long.withColumn("slot", ordering.slot_of(turn, df.sparkSession))
        counted, totals = ordering.count_equal(long, ["fid"], ["value"], measures, tied)
        ranked = ordering.prefix_counts(counted, totals, list(measures), ["fid"], ["value"])
        result = ranked if result is None else result.unionByName(ranked)
    return result


def _whole(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _bin_rules(mode: str, n_rows: Column, n_bins: Column):
    """Row rank (from 0) to bin (from 0), and bin to its first rank."""
    if mode == "ntile":
        size, longer = _whole(n_rows, n_bins), n_rows % n_bins
        edge = longer * (size + 1)
        at_least_one = F.greatest(size, F.lit(1).cast("long"))

        def bin_of(rank: Column) -> Column:
            return F.when(rank < edge, _whole(rank, size + 1)).otherwise(longer + _whole(rank - edge, at_least_one))

        def first_of(b: Column) -> Column:
            return b * size + F.least(b, longer)

        return bin_of, first_of
    if mode == "floor":
        return (
            lambda rank: F.least(n_bins - 1, _whole(rank * n_bins, n_rows)),
            lambda b: _whole(b * n_rows + n_bins - 1, n_bins),
        )
    raise ValueError(f"mode must be 'ntile' or 'floor', got {mode!r}")


def _overlap(low: Column, high: Column, start: Column, end: Column) -> Column:
    return F.greatest(F.least(high, end) - F.greatest(low, start), F.lit(0).cast("long"))


def profile_features(
    df: DataFrame,
    features: Sequence[str] = config.FEATURES,
    label: str = "Class",
    n_bins: int = config.NTILES,
    mode: str = "ntile",
    cuts: DataFrame | None = None,
) -> DataFrame:
    """At most `n_bins` rows per feature, holding all that KS, Cliff's delta, IV and WoE need.

    `mode="ntile"` gives equal-frequency bins whose first ones take the remainder; `"floor"` puts rank i into bin
    floor(i * n_bins / n) and uses no more bins than there are distinct values. Within equal values negatives come
    before positives. Bins are cut by arithmetic on the rank interval a value covers, not by ranking rows.
    Features that lack one of the classes are left out. `cuts`: stored sketches of the table (`value_counts`).
    """
    if n_bins < 1:
        raise ValueError(f"n_bins must be at least 1, got {n_bins}")
    counts = value_counts(df, features, label, cuts).filter((F.col("all_n_pos") > 0) & (F.col("all_n_neg") > 0))
    wanted = F.lit(n_bins).cast("long")
    bins = wanted if mode == "ntile" else F.least(wanted, F.col("all_n_values"))
    bin_of, first_of = _bin_rules(mode, F.col("all_n_all"), F.col("n_bins"))
    share_gap = (F.col("before_n_pos") + F.col("n_pos")) / F.col("all_n_pos") - (
        F.col("before_n_neg") + F.col("n_neg")
    ) / F.col("all_n_neg")
    above_less_below = (
        F.col("n_pos")
        / F.col("all_n_pos")
        * ((F.lit(2) * F.col("before_n_neg") + F.col("n_neg") - F.col("all_n_neg")) / F.col("all_n_neg"))
    )
    start = F.col("before_n_all")
    placed = counts.withColumn("n_bins", bins).withColumns(
        {"first_bin": bin_of(start), "last_bin": bin_of(start + F.col("n_all") - 1)}
    )
    spread = placed.withColumn("b", F.explode(F.sequence("first_bin", "last_bin")))
    low, high = first_of(F.col("b")), first_of(F.col("b") + 1)
    after_neg = start + F.col("n_neg")
    after_pos = after_neg + F.col("n_pos")
    return (
        spread.groupBy("fid", (F.col("b") + 1).alias("bin_id"))
        .agg(
            F.sum(_overlap(low, high, start, start + F.col("n_all"))).alias("n_rows"),
            F.sum(_overlap(low, high, after_neg, after_pos)).alias("n_pos"),
            F.sum(_overlap(low, high, start, after_neg)).alias("n_neg"),
            F.min("value").alias("bin_min"),
            F.max("value").alias("bin_max"),
            F.max(F.abs(share_gap)).alias("ks_part"),
            F.sum(F.when(F.col("b") == F.col("first_bin"), above_less_below).otherwise(F.lit(0.0))).alias("delta_part"),
            F.max("n_bins").alias("n_bins"),
            F.max("all_n_pos").alias("total_pos"),
            F.max("all_n_neg").alias("total_neg"),
        )
        .select(_name(features), "*")
        .drop("fid")
    )


def with_woe(profile: DataFrame) -> DataFrame:
    """Smoothed class shares per bin, their log ratio, and the bin's part of the IV."""
    room = F.lit(config.WOE_SMOOTHING) * F.col("n_bins")
    shares = profile.withColumns(
        {
            "dist_pos": (F.col("n_pos") + F.lit(config.WOE_SMOOTHING)) / (F.col("total_pos") + room),
            "dist_neg": (F.col("n_neg") + F.lit(config.WOE_SMOOTHING)) / (F.col("total_neg") + room),
        }
    ).withColumn("woe", F.ln(F.col("dist_pos") / F.col("dist_neg")))
    return shares.withColumn("iv_contribution", (F.col("dist_pos") - F.col("dist_neg")) * F.col("woe"))


def woe_bins_from(profile: DataFrame) -> DataFrame:
    return with_woe(profile).select(
        "feature",
        "bin_id",
        "bin_min",
        "bin_max",
        "n_rows",
        "n_pos",
        "n_neg",
        "dist_pos",
        "dist_neg",
        "woe",
        "iv_contribution",
    )


def woe_bins(df: DataFrame, features: Sequence[str] = config.FEATURES, label: str = "Class") -> DataFrame:
    return woe_bins_from(profile_features(df, features, label))


def rank_metrics(profile: DataFrame) -> DataFrame:
    """KS, IV and Cliff's delta per feature from the profile."""
    return (
        with_woe(profile)
        .groupBy("feature")
        .agg(
            F.max("ks_part").alias("ks_statistic"),
            F.sum("iv_contribution").alias("information_value"),
            F.sum("delta_part").alias("cliffs_delta"),
            F.max("total_pos").alias("total_pos"),
            F.max("total_neg").alias("total_neg"),
            F.transform(
                F.sort_array(F.collect_list(F.struct("bin_id", "woe"))), lambda entry: entry.getField("woe")
            ).alias("woe_bins"),
        )
    )


def ks_statistic(df: DataFrame, features: Sequence[str] = config.FEATURES, label: str = "Class") -> DataFrame:
    return rank_metrics(profile_features(df, features, label)).select("feature", "ks_statistic")


def cliffs_delta(df: DataFrame, features: Sequence[str] = config.FEATURES, label: str = "Class") -> DataFrame:
    return rank_metrics(profile_features(df, features, label)).select("feature", "cliffs_delta")


def information_value(
    df: DataFrame,
    features: Sequence[str] = config.FEATURES,
    label: str = "Class",
    n_bins: int = config.NTILES,
    mode: str = "ntile",
) -> DataFrame:
    return rank_metrics(profile_features(df, features, label, n_bins, mode)).select("feature", "information_value")


def moments(df: DataFrame, features: Sequence[str] = config.FEATURES, label: str = "Class") -> DataFrame:
    """Class means, spread of the negatives and shape of the positives, one row per feature.

    A single pass with one row of partial state per task; nothing is made long and nothing is shuffled by value.
    """
    wide = df.select(F.col(label).cast("long").alias("label"), *[clean_double(f).alias(f) for f in features])
    entries = []
    for f in features:
        value = F.when(is_finite(F.col(f)), F.col(f))
        pos, neg = F.when(F.col("label") == 1, value), F.when(F.col("label") == 0, value)
        entries.append(
            F.struct(
                F.lit(f).alias("feature"),
                F.avg(pos).alias("mean_pos"),
                F.avg(neg).alias("mean_neg"),
                F.stddev_pop(neg).alias("std_neg"),
                F.skewness(pos).alias("skewness_pos"),
                F.kurtosis(pos).alias("kurtosis_pos"),
            )
        )
    return wide.agg(F.array(*entries).alias("m")).select(F.inline("m"))


def z_score_diff(df: DataFrame, features: Sequence[str] = config.FEATURES, label: str = "Class") -> DataFrame:
    gap = (F.col("mean_pos") - F.col("mean_neg")) / (F.col("std_neg") + F.lit(config.Z_EPSILON))
    return moments(df, features, label).select("feature", "mean_pos", "mean_neg", "std_neg", gap.alias("z_score_diff"))


def _strong() -> Column:
    return (F.col("ks_statistic") >= F.lit(config.STRONG_KS)) & (
        F.abs(F.col("cliffs_delta")) >= F.lit(config.STRONG_DELTA)
    )


def feature_separation(
    df: DataFrame,
    features: Sequence[str] = config.FEATURES,
    label: str = "Class",
    profile: DataFrame | None = None,
    cuts: DataFrame | None = None,
) -> DataFrame:
    """All four separation metrics with their ratings. Pass a stored `profile` to spare the shuffle. `cuts`: stored sketches of the
    table (`value_counts`)."""
    ranked = rank_metrics(profile if profile is not None else profile_features(df, features, label, cuts=cuts))
    both = ranked.join(F.broadcast(z_score_diff(df, features, label)), "feature", "left")
    return both.select(
        "feature",
        "ks_statistic",
        ratings.rate_ks(F.col("ks_statistic")).alias("ks_rating"),
        "information_value",
        ratings.rate_iv(F.col("information_value")).alias("iv_rating"),
        "cliffs_delta",
        F.abs("cliffs_delta").alias("cliffs_delta_abs"),
        ratings.rate_cliffs(F.col("cliffs_delta")).alias("cliffs_rating"),
        "z_score_diff",
        F.abs("z_score_diff").alias("z_score_diff_abs"),
        ratings.rate_z(F.col("z_score_diff")).alias("z_rating"),
        _strong().alias("is_strong_separator"),
    )


def ks_pvalue(ks: Column, n_pos: Column, n_neg: Column) -> Column:
    """Asymptotic two-sample p-value: 2 * sum (-1)^(k-1) exp(-2 k^2 L^2), with L = D * sqrt(n1*n0/(n1+n0))."""
    scaled = F.sqrt(n_pos.cast("double") * n_neg / (n_pos + n_neg)) * ks
    terms = F.aggregate(
        F.sequence(F.lit(1), F.lit(KS_SERIES_TERMS)),
        F.lit(0.0),
        lambda total, k: total + F.when(k % 2 == 1, F.lit(2.0)).otherwise(F.lit(-2.0)) * F.exp(F.lit(-2.0) * k * k * scaled * scaled),
    )
    # Below 0.2 the true value differs from 1 by less than 1e-11, while the cut series has not settled yet.
    return F.when(scaled < 0.2, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), terms)))


def exact_pvalue(gap: int, n_pos: int, n_neg: int) -> float:
    """Chance that a random order of n_pos and n_neg values shows |i / n_pos - j / n_neg| >= gap / (n_pos * n_neg) after some i + j of
    them: the exact p-value of a two-sample KS statistic.

    The orders are lattice paths, walked all at once: the chance of having seen i positives after t values. What reaches
    the bound leaves the walk and is added up, so small p-values keep their digits. Costs (n_pos + n_neg) steps over the
    positions inside the bound. Where Hoeffding's bound for draws without replacement, added up over all steps, lies below the
    least positive double, the result is 0 without a walk; so a walk has at most some 40 sqrt(min(n_pos, n_neg)) positions a step.
    """
    m, n = sorted((n_pos, n_neg))
    if gap <= 0 or m == 0:
        return 1.0
    if 2.0 * (gap / (m + n)) ** 2 / m - math.log(2.0 * (m + n)) > LEAST_LOG:
        return 0.0
    seen = np.arange(m + 1)
    chance = np.zeros(m + 1)
    chance[0], reached = 1.0, 0.0
    for t in range(m + n):
        low, high = max(0, (t * m - gap) // (m + n)), min(m, (t * m + gap) // (m + n) + 1)
        here = slice(low, high + 1)
        p, i = chance[here].copy(), seen[here]
        chance[here] = p * (n - (t - i)) / (m + n - t)
        up = p * (m - i) / (m + n - t)
        chance[low + 1 : high + 2] += up[: m - low] if high == m else up
        near = slice(low, min(m, high + 1) + 1)
        out = np.abs(seen[near] * n - (t + 1 - seen[near]) * m) >= gap
        reached += chance[near][out].sum()
        chance[near] = np.where(out, 0.0, chance[near])
    return min(1.0, float(reached))


@F.pandas_udf(DoubleType())
def _exact_pvalues(ks: pd.Series, n_pos: pd.Series, n_neg: pd.Series) -> pd.Series:
    return pd.Series([exact_pvalue(round(d * m * n), int(m), int(n)) for d, m, n in zip(ks, n_pos, n_neg)])


def feature_report(
    df: DataFrame, features: Sequence[str] = config.FEATURES, label: str = "Class", pvalue: str = "asymptotic"
) -> DataFrame:
    """The interactive feature check: floor-style bins, KS p-value, and the shape of the positive group.

    `pvalue` is "asymptotic", or "exact" (`exact_pvalue`, one task per feature).
    """
    if pvalue not in ("asymptotic", "exact"):
        raise ValueError(f"pvalue must be 'asymptotic' or 'exact', got {pvalue!r}")
    chance = ks_pvalue if pvalue == "asymptotic" else _exact_pvalues
    ranked = rank_metrics(profile_features(df, features, label, mode="floor"))
    if pvalue == "exact":
        place = F.array_position(F.array(*[F.lit(f) for f in features]), F.col("feature")) - 1
        ranked = ranked.repartitionById(len(features), place.cast("int"))
    shape = moments(df, features, label)
    gap = (F.col("mean_pos") - F.col("mean_neg")) / (F.col("std_neg") + F.lit(config.Z_EPSILON))
    return ranked.join(F.broadcast(shape), "feature").select(
        "feature",
        gap.alias("z_score_diff"),
        "ks_statistic",
        chance(F.col("ks_statistic"), F.col("total_pos"), F.col("total_neg")).alias("ks_pvalue"),
        "cliffs_delta",
        F.col("skewness_pos").alias("skewness_fraud"),
        F.col("kurtosis_pos").alias("kurtosis_fraud"),
        "information_value",
        "woe_bins",
        ratings.rate_ks(F.col("ks_statistic")).alias("ks_rating"),
        ratings.rate_iv(F.col("information_value")).alias("iv_rating"),
        ratings.rate_cliffs(F.col("cliffs_delta")).alias("cliffs_rating"),
        ratings.rate_z(gap).alias("z_rating"),
        _strong().alias("is_strong_separator"),
    )


def sampled_cliffs_delta(
    df: DataFrame,
    features: Sequence[str] = config.FEATURES,
    label: str = "Class",
    seed: int = 0,
    draw: Column | None = None,
    max_pos: int | None = None,
    max_neg: int | None = None,
) -> DataFrame:
    """Cliff's delta on at most `max_pos` positives and `max_neg` negatives per feature; on all rows without limits.

    The sample is the rows with the smallest `draw` (default: a seeded hash of the row) that have the feature, so it is
    repeatable. The smallest are found twice: inside shares of a feature and class, dealt by a hash of the draw, and then
    among what the shares hold, so no task sorts all rows of a class.
    """
    if max_pos is None and max_neg is None:
        return cliffs_delta(df, features, label)
    if max_pos is None or max_neg is None:
        raise ValueError("give both max_pos and max_neg, or neither")
    draw = draw if draw is not None else F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in df.columns])
    wide = df.select(
        F.col(label).cast("long").alias("label"), draw.alias("draw"), *[clean_double(f).alias(f) for f in features]
    ).filter(F.col("label").isin(0, 1))
    parts = [part for i, f in enumerate(features) for part in (F.lit(i), F.col(f))]
    sample = wide.select("label", "draw", F.stack(F.lit(len(features)), *parts).alias("fid", "value")).filter(is_finite(F.col("value")))
    share = F.pmod(F.xxhash64("draw", "value"), F.lit(ordering.slots(df.sparkSession)))
    limit = F.when(F.col("label") == 1, F.lit(max_pos)).otherwise(F.lit(max_neg))
    sample = sample.withColumn("share", share)
    for group in (("fid", "label", "share"), ("fid", "label")):
        turn = F.row_number().over(Window.partitionBy(*group).orderBy("draw", "value"))
        sample = sample.withColumn("turn", turn).filter(F.col("turn") <= limit).drop("turn")
    counted = sample.groupBy("fid", "value").agg(
        count_where(F.col("label") == 1).alias("n_pos"), count_where(F.col("label") == 0).alias("n_neg")
    )
    # At most max_pos + max_neg rows per feature from here on.
    feature = Window.partitionBy("fid")
    counted = counted.withColumns(
        {
            "all_neg": F.sum("n_neg").over(feature),
            "upto_neg": F.sum("n_neg").over(feature.orderBy("value").rowsBetween(Window.unboundedPreceding, 0)),
        }
    )
    margin = F.col("n_pos") * (F.lit(2) * F.col("upto_neg") - F.col("n_neg") - F.col("all_neg"))
    return (
        counted.groupBy("fid")
        .agg(F.sum(margin).alias("margin"), F.sum("n_pos").alias("n_pos"), F.sum("n_neg").alias("n_neg"))
        .select(_name(features), F.try_divide(F.col("margin"), F.col("n_pos") * F.col("n_neg")).alias("cliffs_delta"))
    )
