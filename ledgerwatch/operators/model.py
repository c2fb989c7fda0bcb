"""The boosted-tree classifier: class weights, training, scoring, and importances read from the stored trees."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerwatch import config
from ledgerwatch.functions.columns import is_finite
from ledgerwatch.operators import boosting
from ledgerwatch.operators.boosting import Node
from ledgerwatch.session import use_checkpoint_dir
from ledgerwatch.sources import versions

SCALED_AMOUNT = "Amount_scaled"
# The model sees the scaled amount; the separation tables show the raw one.
RAW_NAME = {SCALED_AMOUNT: "Amount"}


def model_features(features: Sequence[str]) -> list[str]:
    """Names inside the model, in vector order."""
    return [f for f in features if f != "Amount"] + ([SCALED_AMOUNT] if "Amount" in features else [])


def class_weights(df: DataFrame, label: str = "Class") -> DataFrame:
    """Inverse class frequency: rows / (classes * rows of the class). One row per class."""
    counts = df.groupBy(F.col(label).cast("long").alias("class_label")).agg(F.count(F.lit(1)).alias("n"))
    every = Window.partitionBy()
    weight = F.sum("n").over(every) / (F.count(F.lit(1)).over(every) * F.col("n"))
    return counts.withColumn("class_weight", weight)


NODE = """tree_id int, node_id int, prediction double, cover double, gain double, left_child int, right_child int,
feature_index int, threshold double, missing_left boolean, gradient double, n_rows long"""
ABOUT = "feature string, input string, place int, mean double, deviation double"


@dataclass(frozen=True)
class BoostedTrees:
    """A trained model: the columns it reads, the scaling of each, and its trees.

    Thresholds and rows are compared as they are; the scaling tells how a feature looks inside the model, where only the amount is
    scaled. `inputs` are the columns of a table, `features` their names in the model, in the order of `Node.feature`.
    """

    features: tuple[str, ...]
    inputs: tuple[str, ...]
    scaling: tuple[tuple[float, float], ...]
    trees: tuple[tuple[Node, ...], ...]

    def rows(self) -> list[tuple]:
        """One row per node, as in `NODE`."""
        out = []
        for tree, nodes in enumerate(self.trees):
            for n in nodes:
                inner = n.feature >= 0
                children = (2 * n.node + 1, 2 * n.node + 2) if inner else (-1, -1)
                out.append((tree, n.node, n.value, n.cover, n.gain, *children, n.feature, n.threshold if inner else None, n.missing_left, n.gradient, n.n_rows))
        return out

    def save(self, spark: SparkSession, path: str) -> None:
        """Store as a new version at `path`; until it is whole, the version before it is the one that loads."""

        def write(folder: str) -> None:
            spark.createDataFrame(self.rows(), NODE).write.parquet(f"{folder}/nodes")
            about = [(f, i, k, *s) for k, (f, i, s) in enumerate(zip(self.features, self.inputs, self.scaling))]
            spark.createDataFrame(about, ABOUT).write.parquet(f"{folder}/about")

        versions.put(spark, path, write)


def load(spark: SparkSession, path: str) -> BoostedTrees:
    """The last version stored at `path`. The nodes are bounded by trees and depth, whatever the data."""
    folder = versions.current(spark, path)
    about = spark.read.schema(ABOUT).parquet(f"{folder}/about").orderBy("place").collect()
    trees: dict[int, list[Node]] = {}
    for r in spark.read.schema(NODE).parquet(f"{folder}/nodes").orderBy("tree_id", "node_id").collect():
        threshold = float("nan") if r.threshold is None else r.threshold
        node = Node(r.node_id, r.gradient, r.cover, r.n_rows, r.prediction, r.feature_index, -1, threshold, r.missing_left, r.gain)
        trees.setdefault(r.tree_id, []).append(node)
    scaling = tuple((a.mean, a.deviation) for a in about)
    return BoostedTrees(tuple(a.feature for a in about), tuple(a.input for a in about), scaling, tuple(tuple(t) for t in trees.values()))


def _scaling(df: DataFrame, column: str) -> tuple[float, float]:
    """Mean and sample deviation of the finite values of a column, from decimal sums, which do not depend on the order of the rows."""
    exact = F.col(column).cast("double").try_cast("decimal(30,10)")
    known = df.filter(is_finite(F.col(column).cast("double"))).select(exact.alias("v"))
    n, mean = known.agg(F.count("v"), F.avg("v")).first()
    if not n:
        return 0.0, 1.0
    gap = (F.col("v").cast("double") - F.lit(float(mean))).try_cast("decimal(30,10)").cast("double")
    squares = known.agg(F.sum((gap * gap).try_cast("decimal(38,10)"))).first()[0]
    return float(mean), (float(squares or 0) / max(1, n - 1)) ** 0.5 or 1.0


def train(
    train_df: DataFrame,
    valid_df: DataFrame,
    path: str,
    features: Sequence[str] = config.FEATURES,
    label: str = "Class",
    max_iter: int = config.MAX_TREES,
    max_depth: int = 6,
    step_size: float = 0.3,
    min_progress: float = 0.01,
    n_bins: int = boosting.MAX_BINS,
) -> BoostedTrees:
    """Fit, store a new version at `path`, and return the model. Training stops early when the validation rows stop gaining.

    The trees are the same however the rows are split or ordered. A missing or infinite feature value does not stop a row: each
    split learns the side such values take. Rows without a label of 0 or 1 take no part. `train_df` is read four times:
    give it a stored table. A training that fails leaves the model that is stored.
    """
    if max_depth < 1:
        raise ValueError(f"max_depth must be at least 1, got {max_depth}")
    spark = train_df.sparkSession
    use_checkpoint_dir(spark)
    inner = model_features(features)
    inputs = [RAW_NAME.get(f, f) for f in inner]
    found = {r.class_label: r.class_weight for r in class_weights(train_df.filter(F.col(label).cast("int").isin(0, 1)), label).collect()}
    settings = boosting.Settings(max_iter, max_depth, step_size, min_progress=min_progress, n_bins=n_bins)
    trees, _ = boosting.fit(train_df, valid_df, inputs, label, (found.get(0, 1.0), found.get(1, 1.0)), settings)
    scaling = tuple(_scaling(train_df, c) if f != c else (0.0, 1.0) for f, c in zip(inner, inputs))
    nodes = tuple(tuple(sorted(t.nodes, key=lambda n: n.node)) for t in trees)
    fitted = BoostedTrees(tuple(inner), tuple(inputs), scaling, nodes)
    fitted.save(spark, path)
    return fitted


def score(model: BoostedTrees, df: DataFrame) -> DataFrame:
    """Input columns, `predicted_Class`, and the positive class's probability as a plain number.

    The trees (bounded by their number and depth) are broadcast; rows are scored in Arrow batches of the model's columns only.
    """
    shared = df.sparkSession.sparkContext.broadcast(model.trees)

    @F.pandas_udf("double")
    def probability(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(1 / (1 + np.exp(-boosting.margins(shared.value, batch.to_numpy(dtype=float)))))

    inputs = F.struct(*[F.col(f"`{c}`").cast("double").alias(f"f{i}") for i, c in enumerate(model.inputs)])
    # Marked so that a filter on the score stays above it: pushed below, the rows that pass would be scored again by one more worker.
    scored = df.withColumn("fraud_probability", probability.asNondeterministic()(inputs))
    label = (F.col("fraud_probability") > F.lit(0.5)).cast("long").alias("predicted_Class")
    return scored.select(*[F.col(f"`{c}`") for c in df.columns], label, "fraud_probability")


def predict(model: BoostedTrees, df: DataFrame, days: tuple[int, int] = config.SCORING_DAYS) -> DataFrame:
    """Score the slices that took no part in training."""
    return score(model, df.filter(F.col("Date").between(*days)))


def tree_nodes(spark: SparkSession, path: str) -> DataFrame:
    """The stored trees as a table: one row per node, with its split and children, the loss reduction of the split (`gain`), and
    the hessian sum of its rows (`cover`)."""
    return spark.read.schema(NODE).parquet(f"{versions.current(spark, path)}/nodes")


def raw_importance(nodes: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean loss reduction per split, mean hessian sum through the split, and number of splits, for every model feature."""
    splits = (
        nodes.filter(F.col("left_child") >= 0)
        .groupBy("feature_index")
        .agg(
            F.avg("gain").alias("importance_gain"),
            F.avg("cover").alias("importance_cover"),
            F.count(F.lit(1)).cast("double").alias("importance_weight"),
        )
    )
    names = nodes.sparkSession.range(len(features)).select(
        F.col("id").cast("int").alias("feature_index"),
        F.element_at(F.array(*[F.lit(f) for f in features]), F.col("id").cast("int") + 1).alias("feature"),
    )
    return names.join(F.broadcast(splits), "feature_index", "left").na.fill(0.0).drop("feature_index")


def importance_report(raw: DataFrame) -> DataFrame:
    """Ranks, shares, concentration of gain in the top five, and the overfit flag. `raw` has one row per feature."""
    every = Window.partitionBy()
    kinds = ("gain", "cover", "weight")
    ranked = raw
    for kind in kinds:
        value = F.col(f"importance_{kind}")
        ranked = ranked.withColumns(
            {
                f"rank_{kind}": F.rank().over(Window.orderBy(value.desc())).cast("long"),
                f"{kind}_share": F.try_divide(value, F.sum(value).over(every)),
            }
        )
    top = F.sum(F.when(F.col("rank_gain") <= config.TOP_GAIN_FEATURES, F.col("gain_share")).otherwise(F.lit(0.0)))
    return ranked.withColumn("top5_gain_share", top.over(every)).select(
        "feature",
        *[f"importance_{k}" for k in kinds],
        *[f"rank_{k}" for k in kinds],
        *[f"{k}_share" for k in kinds],
        "top5_gain_share",
        (F.col("top5_gain_share") >= F.lit(config.TOP_GAIN_SHARE)).alias("top5_gain_concentrated"),
        (
            (F.col("cover_share") < F.lit(config.OVERFIT_COVER_SHARE))
            & (F.col("gain_share") > F.lit(config.OVERFIT_GAIN_SHARE))
        ).alias("cover_overfit_flag"),
    )


def feature_importance(spark: SparkSession, path: str, features: Sequence[str] = config.FEATURES) -> DataFrame:
    return importance_report(raw_importance(tree_nodes(spark, path), model_features(features)))
