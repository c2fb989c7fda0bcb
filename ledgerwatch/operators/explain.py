"""Feature attributions of the boosted trees, and the tables built from them.

The attributions are path-dependent tree Shapley values (Lundberg et al., 2018) in log-odds. They are computed in a
Pandas UDF that sees only the model features: the trees are small, Spark spreads the rows. Everything
after that - averages, ranks, shares, signs - is plain DataFrame work on an array column, and takes attributions from
any other source as well.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from ledgerwatch import config
from ledgerwatch.operators.boosting import Node
from ledgerwatch.operators.model import BoostedTrees

BATCH_ROWS = 4096
TABLE_FEATURES = 6


@dataclass(frozen=True)
class Leaf:
    """The way to a leaf: its features, the interval each value must lie in and whether a missing value passes, the share of
    the training weight that passes a feature's splits by itself, and the leaf's value."""

    features: np.ndarray
    low: np.ndarray
    high: np.ndarray
    missing: np.ndarray
    share: np.ndarray
    value: float


def leaf_paths(nodes: Sequence[Node]) -> list[Leaf]:
    tree = {n.node: n for n in nodes}
    out, pending = [], [(tree[0], {})]
    while pending:
        node, limits = pending.pop()
        if node.feature < 0:
            columns = [np.array([limit[i] for limit in limits.values()]) for i in range(4)]
            out.append(Leaf(np.array(list(limits), int), *columns, node.value))
            continue
        low, high, missing, share = limits.get(node.feature, (-np.inf, np.inf, True, 1.0))
        for child, bounds, passes in (
            (tree[2 * node.node + 1], (low, min(high, node.threshold)), node.missing_left),
            (tree[2 * node.node + 2], (max(low, node.threshold), high), not node.missing_left),
        ):
            pending.append((child, {**limits, node.feature: (*bounds, missing and passes, share * child.cover / node.cover)}))
    return out


def leaf_attributions(leaf: Leaf, x: np.ndarray) -> np.ndarray:
    """Shapley values of one leaf for each row of x, one column per feature of its path.

    The leaf is a product game: a coalition is worth the product of 0 or 1 over the features in it (does the value pass?) and of
    the shares over the others. The weights of coalitions are integrals of t^k (1 - t)^(d - 1 - k), so the value of a
    feature is (passes - share) times the integral of the product of t * passes + (1 - t) * share over the other features.
    That is a polynomial of degree d - 1, which d / 2 Gauss points integrate exactly: the path is extended by a factor per
    feature, and a feature is unwound by a division, at each point. The cost grows with d^2, not 2^d.
    """
    return _game(leaf, _passes(leaf, x).astype(float))


def _passes(leaf: Leaf, x: np.ndarray) -> np.ndarray:
    seen = x[:, leaf.features]
    return np.where(np.isfinite(seen), (seen > leaf.low) & (seen <= leaf.high), leaf.missing)


def _game(leaf: Leaf, passes: np.ndarray) -> np.ndarray:
    """Shapley values of one leaf for rows of 0 and 1, by whether each feature of its path passes."""
    d = len(leaf.features)
    points, weights = np.polynomial.legendre.leggauss((d + 1) // 2)
    out = np.zeros_like(passes)
    for t, weight in zip((points + 1) / 2, weights / 2):
        factor = t * passes + (1 - t) * leaf.share
        out += weight * factor.prod(axis=1, keepdims=True) / factor
    return leaf.value * (passes - leaf.share) * out


def outcomes(leaf: Leaf) -> np.ndarray | None:
    """The Shapley values of a short path for each pattern of features that pass, the first feature the lowest bit; None for others."""
    d = len(leaf.features)
    return _game(leaf, (np.arange(2**d)[:, None] >> np.arange(d) & 1).astype(float)) if 0 < d <= TABLE_FEATURES else None


def attributions(paths: Sequence[Leaf], x: np.ndarray, known: Sequence[np.ndarray | None] | None = None) -> np.ndarray:
    """Shapley values of all leaves for the rows of x, one column per feature. `known`: the `outcomes` of the leaves."""
    known = known if known is not None else [outcomes(leaf) for leaf in paths]
    total = np.zeros_like(x)
    for begin in range(0, len(x), BATCH_ROWS):
        part = x[begin : begin + BATCH_ROWS]
        columns, sums = np.ascontiguousarray(part.T), np.zeros((x.shape[1], len(part)))
        gone = [None if seen.all() else ~seen for seen in np.isfinite(columns)]
        for leaf, table in zip(paths, known):
            if table is not None:
                pattern = np.zeros(len(part), np.intp)
                for k, (f, low, high, missing) in enumerate(zip(leaf.features, leaf.low, leaf.high, leaf.missing)):
                    passes = (columns[f] > low) & (columns[f] <= high)
                    if gone[f] is not None:
                        passes[gone[f]] = missing
                    pattern += passes.view(np.int8) * np.int8(1 << k)
                for f, values in zip(leaf.features, table.T):
                    sums[f] += values.take(pattern)
            elif len(leaf.features):
                sums[leaf.features] += leaf_attributions(leaf, part).T
        total[begin : begin + BATCH_ROWS] = sums.T
    return total


def with_attributions(df: DataFrame, model: BoostedTrees) -> DataFrame:
    """Add `attributions`, one number per model feature, whatever the depth of the trees. The paths of the leaves are broadcast;
    they are bounded by the number of trees and their depth."""
    shared = df.sparkSession.sparkContext.broadcast([leaf for tree in model.trees for leaf in leaf_paths(tree)])

    @F.pandas_udf(ArrayType(DoubleType()))
    def attribute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        known = [outcomes(leaf) for leaf in shared.value]
        for batch in batches:
            yield pd.Series(list(attributions(shared.value, batch.to_numpy(dtype=float), known)))

    inputs = [F.col(f"`{c}`").cast("double").alias(f"f{i}") for i, c in enumerate(model.inputs)]
    return df.withColumn("attributions", attribute(F.struct(*inputs)))


def base_value(model: BoostedTrees) -> float:
    """The log-odds that the attributions of a row are added to: the mean leaf by training weight."""
    return sum(leaf.value * float(leaf.share.prod()) for tree in model.trees for leaf in leaf_paths(tree))


def global_attributions(attributed: DataFrame, names: Sequence[str]) -> DataFrame:
    """Signed and absolute mean attribution per feature, in one pass without a shuffle by feature."""
    entries = [
        F.struct(
            F.lit(name).alias("feature"),
            F.avg(F.col("attributions")[i]).alias("attribution"),
            F.avg(F.abs(F.col("attributions")[i])).alias("mean_abs_shap"),
        )
        for i, name in enumerate(names)
    ]
    return attributed.agg(F.array(*entries).alias("g")).select(F.inline("g"))


def global_report(raw: DataFrame, audit: Sequence[str] = config.AUDIT_FEATURES) -> DataFrame:
    """Rank, share and audit flags; `raw` has one row per feature with its signed mean attribution."""
    size = F.abs("attribution")
    ranked = raw.withColumns(
        {
            "abs_attribution": size,
            "rank_shap": F.rank().over(Window.orderBy(size.desc())).cast("long"),
            "shap_share": F.try_divide(size, F.sum(size).over(Window.partitionBy())),
        }
    )
    audited = F.col("feature").isin(*audit)
    extra = [c for c in raw.columns if c not in ("feature", "attribution")]
    return ranked.select(
        "feature",
        "attribution",
        "abs_attribution",
        "rank_shap",
        "shap_share",
        audited.alias("is_audit_variable"),
        (audited & (F.col("rank_shap") <= 5)).alias("audit_in_top5"),
        *extra,
    )


def high_risk(
    predictions: DataFrame,
    tie_break: Sequence[str | Column] = (),
    score: float = config.EXPLAIN_SCORE,
    top: int = config.EXPLAIN_TOP_ROWS,
) -> DataFrame:
    """Rows scored at or above `score`, and the `top` best-scored rows whatever their score.

    The top rows come from a bounded sort in each task, not from a ranking of the table.
    """
    p = F.col("fraud_probability")
    best = predictions.orderBy(p.desc_nulls_last(), *tie_break).limit(top)
    below = p.isNull() | (p < F.lit(score))
    return predictions.filter(p >= F.lit(score)).unionByName(best.filter(below))


def local_report(
    attributed: DataFrame,
    names: Sequence[str],
    global_table: DataFrame,
    label: str = "Class",
    top: int = config.EXPLAIN_TOP_FEATURES,
    keep: Sequence[str] = ("Time", "Amount", "Hour"),
) -> DataFrame:
    """The strongest attributions of each row, one per output row, compared with the feature's global sign."""
    entries = F.array(
        *[
            F.struct(
                F.abs(F.col("attributions")[i]).alias("size"),
                F.lit(-i).alias("place"),
                F.lit(name).alias("feature"),
                F.col("attributions")[i].alias("attribution"),
            )
            for i, name in enumerate(names)
        ]
    )
    strongest = F.slice(F.sort_array(entries, asc=False), 1, top)
    rows = attributed.select(
        *keep,
        F.col(label).cast("long").alias("class_label"),
        "predicted_Class",
        "fraud_probability",
        F.posexplode(strongest).alias("place", "entry"),
    )
    signs = global_table.select(
        F.col("feature").alias("shap_feature"), F.signum("attribution").alias("global_sign")
    )
    named = rows.select(
        *keep,
        "class_label",
        "predicted_Class",
        "fraud_probability",
        F.col("entry.feature").alias("shap_feature"),
        F.col("entry.attribution").alias("shap_attribution"),
        (F.col("place") + 1).cast("long").alias("shap_rank"),
    )
    joined = named.join(F.broadcast(signs), "shap_feature", "left")
    local = F.signum("shap_attribution")
    return joined.select(
        *keep,
        "class_label",
        "predicted_Class",
        "fraud_probability",
        "shap_feature",
        "shap_attribution",
        "shap_rank",
        "global_sign",
        local.alias("local_sign"),
        (
            F.col("global_sign").isNull() | (local == F.col("global_sign")) | (F.col("shap_attribution") == 0)
        ).alias("direction_consistent"),
    )


def global_explain(df: DataFrame, model: BoostedTrees, audit: Sequence[str] = config.AUDIT_FEATURES) -> DataFrame:
    return global_report(global_attributions(with_attributions(df, model), model.features), audit)


def local_explain(
    predictions: DataFrame,
    global_table: DataFrame,
    model: BoostedTrees,
    label: str = "Class",
    tie_break: Sequence[str | Column] = ("Time", "Amount", "V1"),
) -> DataFrame:
    """Explain the high-risk rows. Each row carries its own features, so nothing is joined back by key."""
    attributed = with_attributions(high_risk(predictions, tie_break), model)
    return local_report(attributed, model.features, global_table, label)
