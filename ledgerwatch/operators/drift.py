"""Score drift: the population stability index between two score distributions."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerwatch import config
from ledgerwatch.functions import ratings
from ledgerwatch.functions.columns import clean_double, is_finite
from ledgerwatch.operators import ordering


def score_histogram(
    df: DataFrame, score: str = "fraud_probability", n_bins: int = config.PSI_BINS, by: Sequence[str] = ()
) -> DataFrame:
    """(bin_id, n) over equal-width bins of [0, 1], for each group of the columns `by`; at most `n_bins` rows each.

    Missing and non-finite scores are left out.
    """
    value = clean_double(score)
    bin_id = F.least(F.floor(value * F.lit(n_bins)).cast("long"), F.lit(n_bins - 1).cast("long"))
    return df.filter(is_finite(value)).groupBy(*by, bin_id.alias("bin_id")).agg(F.count(F.lit(1)).alias("n"))


def _shares(histogram: DataFrame, name: str) -> DataFrame:
    total = F.sum("n").over(Window.partitionBy())
    return histogram.select("bin_id", F.col("n").alias(f"{name}_n"), total.alias(f"{name}_total"))


def _contribution(baseline: Column, daily: Column) -> Column:
    return (daily - baseline) * F.ln(daily / baseline)


def psi(baseline: DataFrame, daily: DataFrame, n_bins: int = config.PSI_BINS) -> DataFrame:
    """PSI per bin and in total from two score histograms; empty if either side has no scores.

    A side's total is repeated on each of its rows, so a bin that only one side has takes the total from the maximum
    over the ten rows.
    """
    bins = baseline.sparkSession.range(n_bins).withColumnRenamed("id", "bin_id")
    every = Window.partitionBy()
    both = bins.join(F.broadcast(_shares(baseline, "baseline")), "bin_id", "left").join(
        F.broadcast(_shares(daily, "daily")), "bin_id", "left"
    )
    # Scores outside [0, 1] have a bin that is not listed; they count in the totals only.
    totals = both.withColumns(
        {
            "baseline_total": F.max("baseline_total").over(every),
            "daily_total": F.max("daily_total").over(every),
        }
    ).filter(F.col("baseline_total").isNotNull() & F.col("daily_total").isNotNull())
    floor = F.lit(config.PSI_FLOOR)

    def share(side: str) -> Column:
        raw = F.coalesce(F.col(f"{side}_n"), F.lit(0)) / F.col(f"{side}_total")
        return F.greatest(raw, floor).alias(f"{side}_pct")

    parts = totals.select("bin_id", share("baseline"), share("daily")).withColumn(
        "psi_contribution", _contribution(F.col("baseline_pct"), F.col("daily_pct"))
    )
    whole = parts.withColumn("psi", F.sum("psi_contribution").over(every))
    return whole.withColumn("psi_rating", ratings.rate_psi(F.col("psi")))


def psi_by(baseline: DataFrame, daily: DataFrame, by: Sequence[str], n_bins: int = config.PSI_BINS) -> DataFrame:
    """(by, psi, psi_rating): the total of `psi` for every group of `daily`, a histogram with the columns `by`, in one pass."""
    old = baseline.groupBy().pivot("bin_id", list(range(n_bins))).agg(F.sum("n"))
    sides = old.select(F.array(*[F.coalesce(F.col(f"`{i}`"), F.lit(0)) for i in range(n_bins)]).alias("old_n"))
    whole = baseline.agg(F.sum("n").alias("old_total")).filter("old_total IS NOT NULL")
    new_n = F.array(*[F.sum(F.when(F.col("bin_id") == i, F.col("n")).otherwise(F.lit(0))) for i in range(n_bins)])
    groups = daily.groupBy(*by).agg(new_n.alias("new_n"), F.sum("n").alias("new_total"))
    both = groups.join(F.broadcast(sides)).join(F.broadcast(whole))  # one row each
    floor = F.lit(config.PSI_FLOOR)

    def share(side: str, i: int) -> Column:
        return F.greatest(F.col(f"{side}_n")[i] / F.col(f"{side}_total"), floor)

    total = sum((_contribution(share("old", i), share("new", i)) for i in range(1, n_bins)), _contribution(share("old", 0), share("new", 0)))
    return both.select(*by, total.alias("psi")).withColumn("psi_rating", ratings.rate_psi(F.col("psi")))


def psi_of_scores(
    baseline: DataFrame, daily: DataFrame, score: str = "fraud_probability", daily_score: str | None = None
) -> DataFrame:
    return psi(score_histogram(baseline, score), score_histogram(daily, daily_score or score))


def psi_by_edges(
    baseline: DataFrame,
    daily: DataFrame,
    score: str = "fraud_probability",
    daily_score: str | None = None,
    n_bins: int = config.PSI_BINS,
) -> DataFrame:
    """The interactive variant: scores are clipped to [0, 1] and binned between evenly spaced edges; one row."""
    step = 1.0 / n_bins
    splits = [-math.inf, *[i * step for i in range(1, n_bins)], math.inf]

    def counts(df: DataFrame, name: str, side: str) -> DataFrame:
        known = df.select(clean_double(name).alias("p")).filter(is_finite(F.col("p")))
        clipped = known.select(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("p"))).alias("p"))
        binned = ordering.bucketize(clipped, {"p": splits}, {"p": "b"})
        return binned.groupBy((F.col("b") - 1).alias("bin_id")).agg(F.count(F.lit(1)).alias(side))

    bins = baseline.sparkSession.range(n_bins).withColumnRenamed("id", "bin_id")
    both = bins.join(F.broadcast(counts(baseline, score, "old")), "bin_id", "left").join(
        F.broadcast(counts(daily, daily_score or score, "new")), "bin_id", "left"
    )
    every, one = Window.partitionBy(), F.lit(1).cast("long")

    def share(side: str) -> Column:
        n = F.coalesce(F.col(side), F.lit(0))
        return F.greatest(n / F.greatest(F.sum(n).over(every), one), F.lit(config.PSI_FLOOR)).alias(side)

    total = both.select(share("old"), share("new")).agg(F.sum(_contribution(F.col("old"), F.col("new"))).alias("psi"))
    return total.withColumn("psi_rating", ratings.rate_psi(F.col("psi")))
