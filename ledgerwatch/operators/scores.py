"""Quality of a scored table under heavy class imbalance.

Average precision, capture rates, the cost curve with its best threshold, and the classic classifier figures.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerwatch import config
from ledgerwatch.config import ScoreColumns
from ledgerwatch.functions import ratings
from ledgerwatch.functions.columns import clean_double, count_where
from ledgerwatch.operators import ordering
from ledgerwatch.sources import sketches

DIRECT_TERMS = 1000
TINY_PROBABILITY = 1e-15


def scored(df: DataFrame, columns: ScoreColumns = ScoreColumns(), by: Sequence[str] = ()) -> DataFrame:
    """The three columns the score metrics read, after those of `by`; rows without a score are dropped."""
    return df.select(
        *by,
        F.col(columns.label).cast("long").alias("class_label"),
        clean_double(columns.amount).alias("amount"),
        clean_double(columns.score).alias("fraud_probability"),
    ).filter(F.col("fraud_probability").isNotNull())


def merge_single_rows(*rows: DataFrame) -> DataFrame:
    """Put one-row tables with different columns side by side; no rows if any of them is empty."""
    stacked = rows[0]
    for row in rows[1:]:
        stacked = stacked.unionByName(row, allowMissingColumns=True)
    names = [c for row in rows for c in row.columns]
    merged = stacked.agg(F.count(F.lit(1)).alias("__rows"), *[F.max(c).alias(c) for c in names])
    return merged.filter(F.col("__rows") == len(rows)).drop("__rows")


# --- ranking ---------------------------------------------------------------------------------------------------


def class_counts() -> dict[str, Column]:
    return {
        "n_pos": count_where(F.col("class_label") == 1),
        "n_neg": count_where(F.col("class_label") == 0),
        "n_all": F.count(F.lit(1)),
    }


@dataclass(frozen=True)
class Ladder:
    """`steps`: one row per (group, score, amount), best score first, with the class counts before it and in total.

    `hot` are the scores that are so frequent that their amounts lie in several cells.
    """

    steps: DataFrame
    by: tuple[str, ...]
    hot: tuple[float, ...]


def ladder(
    scores: DataFrame, by: Sequence[str] = (), measures: dict[str, Column] | None = None, cuts: DataFrame | None = None, score: str = "fraud_probability"
) -> Ladder:
    """Order all rows by score, in each group of the columns `by`, in one pass.

    `scores` is the output of `scored`, or of `score_ladder` with sums of its counts as measures. Equal (score, amount) rows are counted
    before anything is ordered. Cells are cut for all groups together, so a large group is as spread as a table of its own.
    `cuts` are the stored sketches of the table, which know the column `score`; without them samples are read while the plan
    is built.
    """
    measures = measures or class_counts()
    keyed = scores.withColumn("rank_key", F.when(F.col("fraud_probability") == 0, F.lit(0.0)).otherwise(-F.col("fraud_probability")))

    def descending(n: int) -> list[float]:
        return [0.0 if p == 0 else -p for p in reversed(sketches.points(cuts, [score], n).get(score, []))]

    cells = ordering.plan_cells(keyed, ["rank_key", "amount"], known=descending if cuts is not None else None)
    keys = ["rank_key", "amount"]
    counted, totals = ordering.count_equal(cells.assign(keyed), list(by), keys, measures, cells.tied)
    steps = ordering.prefix_counts(counted, totals, list(measures), list(by), keys, few_groups=not by)
    return Ladder(steps, tuple(by), cells.levels[0].hot)


def score_ladder(df: DataFrame, columns: ScoreColumns = ScoreColumns(), by: Sequence[str] = ()) -> DataFrame:
    """(group, fraud_probability, amount, n_pos, n_neg, n_all): what the ranking needs of a day, and can be pooled with other days."""
    kept = scored(df, columns, by)
    return kept.groupBy(*by, "fraud_probability", "amount").agg(*[m.alias(n) for n, m in class_counts().items()])


def roc_auc(rungs: Ladder) -> DataFrame:
    """(group, roc_auc) from the order of the ladder: the share of pairs of a positive and a negative in which the positive scores
    higher, ties counting half. Null where a class is missing.

    Steps of one score are put together inside their cell; only the hot scores, which lie in several cells, meet once more.
    """
    by = list(rungs.by)
    sums = {"pos": F.sum("n_pos"), "neg": F.sum("n_neg"), "before": F.min("before_n_neg"), "all_pos": F.max("all_n_pos"), "all_neg": F.max("all_n_neg")}
    here = rungs.steps.groupBy("slot", *by, "cell", "rank_key").agg(*[c.alias(n) for n, c in sums.items()])
    names = [*by, "rank_key", *sums]
    tied = here.select(names)
    if rungs.hot:
        several = F.coalesce(F.col("rank_key").isin(*rungs.hot), F.lit(False))
        again = {"pos": F.sum("pos"), "neg": F.sum("neg"), "before": F.min("before"), "all_pos": F.max("all_pos"), "all_neg": F.max("all_neg")}
        met = here.filter(several).groupBy(*by, "rank_key").agg(*[c.alias(n) for n, c in again.items()])
        tied = here.filter(~several).select(names).unionByName(met)
    won = F.col("pos") * (F.col("all_neg") - F.col("before") - F.col("neg")) + F.col("pos") * F.col("neg") / 2
    total = tied.groupBy(*by).agg(F.sum(won).alias("won"), F.max("all_pos").alias("n_pos"), F.max("all_neg").alias("n_neg"))
    pairs = F.col("n_pos").cast("double") * F.col("n_neg")
    return total.select(*by, F.when(pairs > 0, F.col("won") / pairs).alias("roc_auc"))


def _harmonic_gap(low: Column, high: Column) -> Column:
    """H(high) - H(low) for low >= 1000, where H are harmonic numbers; exact to double precision there."""

    def tail(x: Column) -> Column:
        inverse = F.lit(1.0) / x
        return inverse / 2 - inverse * inverse / 12

    return F.log1p((high - low) / low) + tail(high) - tail(low)


def precision_sum(tp: Column, fp: Column, n_pos: Column) -> Column:
    """Sum over j = 1..n_pos of (tp + j) / (tp + j + fp): a group's share of average precision.

    The first 1000 terms are added one by one; the rest of a larger group follows from harmonic numbers, so a group
    of any size costs the same.
    """
    direct = F.least(n_pos, F.lit(DIRECT_TERMS).cast("long"))
    one_by_one = F.aggregate(
        F.sequence(F.lit(1).cast("long"), F.greatest(direct, F.lit(1).cast("long"))),
        F.lit(0.0),
        lambda total, j: total + (tp + j) / (tp + j + fp),
    )
    low, high = (tp + fp + direct).cast("double"), (tp + fp + n_pos).cast("double")
    rest = (n_pos - direct).cast("double") - fp.cast("double") * _harmonic_gap(low, high)
    return (
        F.when(n_pos == 0, F.lit(0.0))
        .when(n_pos == 1, (tp + 1) / (tp + 1 + fp))
        .when(n_pos <= DIRECT_TERMS, one_by_one)
        .otherwise(one_by_one + rest)
    )


def top_rows(n_rows: Column, share: float) -> Column:
    return F.greatest(F.ceil(n_rows * F.lit(share)).cast("long"), F.lit(1).cast("long"))


def ranking_of(rungs: Ladder) -> DataFrame:
    """Row counts, average precision and the two capture rates, one row per group; no row if nothing is scored.

    Order: score descending, amount ascending, negatives before positives among equals.
    """
    by = list(rungs.by)
    steps = rungs.steps.withColumns(
        {"k_0_1": top_rows(F.col("all_n_all"), config.CAPTURE_SHARES[0]), "k_0_5": top_rows(F.col("all_n_all"), config.CAPTURE_SHARES[1])}
    )

    def caught(k: str) -> Column:
        left = F.col(k) - F.col("before_n_all") - F.col("n_neg")
        return F.sum(F.greatest(F.least(left, F.col("n_pos")), F.lit(0).cast("long"))).alias(f"caught_{k}")

    precision = precision_sum(F.col("before_n_pos"), F.col("before_n_neg") + F.col("n_neg"), F.col("n_pos"))
    total = steps.withColumn("precision", precision).groupBy(*by).agg(
        F.max("all_n_all").alias("n_rows"),
        F.max("all_n_pos").alias("n_pos"),
        F.max("all_n_neg").alias("n_neg"),
        F.sum("precision").alias("precision_sum"),
        F.max("k_0_1").alias("k_0_1"),
        F.max("k_0_5").alias("k_0_5"),
        caught("k_0_1"),
        caught("k_0_5"),
    ).filter(F.col("n_rows").isNotNull())
    return total.select(
        *by,
        "n_rows",
        "n_pos",
        "n_neg",
        F.coalesce(F.try_divide(F.col("precision_sum"), F.col("n_pos")), F.lit(0.0)).alias("pr_auc"),
        F.try_divide(F.col("caught_k_0_1"), F.col("n_pos")).alias("capture_rate_0_1pct"),
        F.try_divide(F.col("caught_k_0_5"), F.col("n_pos")).alias("capture_rate_0_5pct"),
        "k_0_1",
        "k_0_5",
    )


def ranking_metrics(scores: DataFrame, cuts: DataFrame | None = None, score: str = "fraud_probability") -> DataFrame:
    return ranking_of(ladder(scores, cuts=cuts, score=score))


def pooled_ranking(ladders: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The ranking figures of stored ladders (`score_ladder`), those of a group pooled: as over the single rows of all its days."""
    return ranking_of(ladder(ladders, by, {name: F.sum(name) for name in class_counts()}))


def pr_auc(df: DataFrame, columns: ScoreColumns = ScoreColumns(), cuts: DataFrame | None = None) -> DataFrame:
    """Average precision. `cuts`: stored sketches of the table (`ladder`)."""
    return ranking_metrics(scored(df, columns), cuts, columns.score).select("n_pos", "pr_auc")


def capture_rate(df: DataFrame, share: float, columns: ScoreColumns = ScoreColumns(), cuts: DataFrame | None = None) -> DataFrame:
    """Share of all positives among the best max(ceil(n * share), 1) rows. `cuts`: stored sketches of the table (`ladder`)."""
    steps = ladder(scored(df, columns), cuts=cuts, score=columns.score).steps.withColumn("k", top_rows(F.col("all_n_all"), share))
    left = F.col("k") - F.col("before_n_all") - F.col("n_neg")
    return (
        steps.agg(
            F.max("k").alias("k"),
            F.sum(F.greatest(F.least(left, F.col("n_pos")), F.lit(0).cast("long"))).alias("caught"),
            F.max("all_n_pos").alias("n_pos"),
        )
        .filter(F.col("k").isNotNull())
        .select("k", F.try_divide(F.col("caught"), F.col("n_pos")).alias("capture_rate"))
    )


# --- cost ------------------------------------------------------------------------------------------------------


def cost_curve(df: DataFrame, columns: ScoreColumns = ScoreColumns(), by: Sequence[str] = ()) -> DataFrame:
    """Expected loss at 99 thresholds, for each group of the columns `by`. One pass: rows are counted between neighbouring
    thresholds, then summed up. After the first aggregate a group has at most 100 rows.
    """
    by = list(by)
    edges = [-math.inf, *config.THRESHOLDS, math.inf]
    positive, negative = F.col("class_label") == 1, F.col("class_label") == 0
    between = (
        ordering.bucketize(scored(df, columns, by), {"fraud_probability": edges}, {"fraud_probability": "step"})
        .groupBy(*by, (F.col("step") - 1).alias("step"))
        .agg(
            F.sum(F.when(positive, F.col("amount") + F.lit(config.CHARGEBACK_FEE)).otherwise(F.lit(0.0))).alias("loss"),
            count_where(positive).alias("pos"),
            count_where(negative).alias("neg"),
            F.count(F.lit(1)).alias("n_all"),
        )
    )
    steps = df.sparkSession.range(0, len(edges)).withColumnRenamed("id", "step")
    if by:
        steps = between.select(*by).distinct().withColumn("step", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(len(edges) - 1).cast("long"))))
    figures = ["loss", "pos", "neg", "n_all"]
    dense = steps.join(between if by else F.broadcast(between), [*by, "step"], "left").na.fill(0, figures)
    every = Window.partitionBy(*by)
    below = every.orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    summed = dense.select(
        *by,
        "step",
        F.sum("loss").over(below).alias("fn_loss"),
        F.sum("pos").over(below).alias("fn_count"),
        F.sum("neg").over(below).alias("tn_count"),
        F.sum(F.when(F.col("step") < len(edges) - 1, F.col("pos"))).over(every).alias("all_pos"),
        F.sum(F.when(F.col("step") < len(edges) - 1, F.col("neg"))).over(every).alias("all_neg"),
        F.sum("n_all").over(every).alias("n_all"),
    ).filter(F.col("step").between(1, len(config.THRESHOLDS)) & (F.col("n_all") > 0))
    counts = summed.select(
        *by,
        F.element_at(F.array(*[F.lit(t) for t in config.THRESHOLDS]), F.col("step").cast("int")).alias("threshold"),
        "fn_loss",
        (F.col("all_pos") - F.col("fn_count")).alias("tp_count"),
        "fn_count",
        (F.col("all_neg") - F.col("tn_count")).alias("fp_count"),
        "tn_count",
    )
    priced = counts.select(
        *by,
        "threshold",
        "fn_loss",
        (F.col("fp_count") * F.lit(config.FALSE_ALARM_COST)).alias("fp_loss"),
        (F.col("tp_count") * F.lit(config.REVIEW_COST)).alias("tp_cost"),
        "tp_count",
        "fn_count",
        "fp_count",
        "tn_count",
    ).withColumn("expected_loss", F.col("fn_loss") + F.col("fp_loss") + F.col("tp_cost"))
    return priced.select(
        *by,
        "threshold",
        "fn_loss",
        "fp_loss",
        "tp_cost",
        "expected_loss",
        "tp_count",
        "fn_count",
        "fp_count",
        "tn_count",
        (F.col("expected_loss") == F.min("expected_loss").over(every)).alias("is_optimal_threshold"),
    )


def optimal_threshold(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The row of a cost curve with the least loss, for each group of the columns `by`; the smallest threshold wins a tie."""
    best = curve.orderBy("expected_loss", "threshold").limit(1)
    if by:
        least = F.min_by(F.struct(*[c for c in curve.columns if c not in by]), F.struct("expected_loss", "threshold"))
        best = curve.groupBy(*by).agg(least.alias("best")).select(*by, "best.*")
    return best.select(
        *by,
        F.col("threshold").alias("optimal_threshold"),
        F.col("expected_loss").alias("min_expected_loss"),
        F.col("fn_loss").alias("fn_loss_at_opt"),
        F.col("fp_loss").alias("fp_loss_at_opt"),
        F.col("tp_cost").alias("tp_cost_at_opt"),
    )


def imbalance_metrics(
    df: DataFrame,
    columns: ScoreColumns = ScoreColumns(),
    curve: DataFrame | None = None,
    ranking: DataFrame | None = None,
    by: Sequence[str] = (),
    cuts: DataFrame | None = None,
) -> DataFrame:
    """The summary, one row per group. Pass a stored cost curve, or a stored ranking, to spare its scan. `cuts`: stored sketches of
    the table (`ladder`)."""
    best = optimal_threshold(curve if curve is not None else cost_curve(df, columns, by), by)
    ranked = ranking if ranking is not None else ranking_of(ladder(scored(df, columns, by), by, cuts=cuts, score=columns.score))
    both = ranked.join(best, list(by)) if by else merge_single_rows(ranked, best)
    n_pos = F.col("n_pos")
    return both.select(
        *by,
        "n_rows",
        "n_pos",
        "n_neg",
        "pr_auc",
        ratings.unless_no_positives(n_pos, ratings.rate_pr_auc(F.col("pr_auc"))).alias("pr_auc_rating"),
        "capture_rate_0_1pct",
        "capture_rate_0_5pct",
        "k_0_1",
        "k_0_5",
        ratings.unless_no_positives(n_pos, ratings.rate_capture_0_1(F.col("capture_rate_0_1pct"))).alias("capture_0_1_rating"),
        ratings.unless_no_positives(n_pos, ratings.rate_capture_0_5(F.col("capture_rate_0_5pct"))).alias("capture_0_5_rating"),
        "optimal_threshold",
        "min_expected_loss",
        "fn_loss_at_opt",
        "fp_loss_at_opt",
        "tp_cost_at_opt",
    )


# --- classifier figures ----------------------------------------------------------------------------------------


def evaluate(
    df: DataFrame,
    columns: ScoreColumns = ScoreColumns(),
    cutoff: float = 0.5,
    area: DataFrame | None = None,
    by: Sequence[str] = (),
    cuts: DataFrame | None = None,
) -> DataFrame:
    """Precision, recall, accuracy, F1, log loss and ROC-AUC of a scored table, one row per group. Rows without a label do not count.

    ROC-AUC comes from the order of scores that average precision uses (`roc_auc`); pass a stored one to spare its scan.
    """
    rows = scored(df, columns, by).filter(F.col("class_label").isNotNull())
    hit, positive = F.col("fraud_probability") >= F.lit(cutoff), F.col("class_label") == 1
    sure = F.greatest(F.lit(TINY_PROBABILITY), F.least(F.lit(1.0 - TINY_PROBABILITY), F.col("fraud_probability")))
    counts = rows.groupBy(*by).agg(
        count_where(hit & positive).alias("tp"),
        count_where(hit & ~positive).alias("fp"),
        count_where(~hit & positive).alias("fn"),
        count_where(~hit & ~positive).alias("tn"),
        F.avg(-F.when(positive, F.ln(sure)).otherwise(F.ln(F.lit(1.0) - sure))).alias("log_loss"),
    )
    if area is None:
        area = roc_auc(ladder(scored(df, columns, by), by, cuts=cuts, score=columns.score))
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    both = counts.join(area, list(by), "left") if by else merge_single_rows(counts, area.agg(F.max("roc_auc").alias("roc_auc")))
    return both.select(
        *by,
        F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0)).alias("recall"),
        F.try_divide(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        F.coalesce(F.try_divide(F.lit(2.0) * tp, F.lit(2.0) * tp + fp + fn), F.lit(0.0)).alias("f1_score"),
        "log_loss",
        "roc_auc",
    )


def metrics_by(df: DataFrame, by: str = "Date", columns: ScoreColumns = ScoreColumns(), cuts: DataFrame | None = None) -> DataFrame:
    """The figures of `imbalance_metrics` and `evaluate` for every value of a column, all from one order of the scores.

    A year of days costs one pass, not one per day. Rows without a value of `by` are left out.
    """
    known = df.filter(F.col(by).isNotNull())
    rungs = ladder(scored(known, columns, [by]), [by], cuts=cuts, score=columns.score)
    imbalance = imbalance_metrics(known, columns, ranking=ranking_of(rungs), by=[by])
    return imbalance.join(evaluate(known, columns, area=roc_auc(rungs), by=[by]), by)


def daily_kpis(predictions: DataFrame, predicted: str = "predicted_Class") -> DataFrame:
    """Transactions, detected frauds and their share."""
    found = count_where(F.col(predicted).cast("string").isin("1", "1.0"))
    return predictions.agg(F.count(F.lit(1)).alias("transactions"), found.alias("detected_frauds")).withColumn(
        "fraud_pct", F.try_divide(F.col("detected_frauds") * F.lit(100.0), F.col("transactions"))
    )
