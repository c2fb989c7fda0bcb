"""One query per operator, each over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixture
from checks.fixture import AUDIT, EVENT_FEATURES, FEATURES, RUN_TS, SCORE, rounded
from ledgerwatch import config
from ledgerwatch.functions.columns import stamp
from ledgerwatch.operators import drift, explain, history, model, scorecards, scores, separation, slicing
from ledgerwatch.plans import daily, initial
from ledgerwatch.plans.names import Tables
from ledgerwatch.sources import tables as sources

MODEL_FEATURES = model.model_features(FEATURES)
SECOND_RUN = "2024-02-03T16:30:00"
PLAIN_COLUMNS = ("Time", "V1", "V2", "V3", "Amount", "Class", "score")


# --- data movement ---------------------------------------------------------------------------------------------


def copy_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = fixture.work_tables(spark, "copy")
    sources.replace_table(fixture.transactions(spark, sf_dir), tables["outside"])
    sources.copy_source(spark, tables["outside"], tables["public"])
    return spark.table(tables["public"])


def add_hour(spark, sf_dir):
    return fixture.with_hour(spark, sf_dir)


def assign_pseudo_day(spark, sf_dir):
    return fixture.sliced(spark, sf_dir)


def extract_day(spark, sf_dir):
    return slicing.extract_day(fixture.transactions(spark, sf_dir), 15)


def split_by_day(spark, sf_dir):
    parts = slicing.split_by_day(fixture.stored(spark, sf_dir))
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("Class") == 1).alias("n_pos")).withColumn("part", F.lit(name))
        for name, df in parts.items()
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


def overwrite_slice(spark, sf_dir):
    """Load two slices after one another, then an empty one: the second slice must be what is left."""
    tables = fixture.work_tables(spark, "load")
    source = fixture.stored(spark, sf_dir)
    for day in (3, 7):
        sources.overwrite_slice(slicing.stored_day(source, day), tables["batch"])
    try:
        sources.overwrite_slice(source.filter(F.col("Date") > 50), tables["batch"])
    except sources.EmptyInput:
        pass
    return spark.table(tables["batch"])


# --- features --------------------------------------------------------------------------------------------------


def unpivot_features(spark, sf_dir):
    return separation.unpivot_features(fixture.with_hour(spark, sf_dir), FEATURES)


def ks_statistic(spark, sf_dir):
    return rounded(separation.ks_statistic(fixture.with_hour(spark, sf_dir), FEATURES))


def cliffs_delta(spark, sf_dir):
    return rounded(separation.cliffs_delta(fixture.with_hour(spark, sf_dir), FEATURES))


def z_score_diff(spark, sf_dir):
    return rounded(separation.z_score_diff(fixture.with_hour(spark, sf_dir), FEATURES))


def information_value(spark, sf_dir):
    return rounded(separation.information_value(fixture.with_hour(spark, sf_dir), FEATURES))


def information_value_floor(spark, sf_dir):
    return rounded(separation.information_value(fixture.with_hour(spark, sf_dir), FEATURES, mode="floor"))


def feature_separation(spark, sf_dir):
    return rounded(separation.feature_separation(fixture.stored(spark, sf_dir), FEATURES, cuts=fixture.cuts(spark, sf_dir)))


def feature_separation_events(spark, sf_dir):
    return rounded(separation.feature_separation(fixture.events(spark, sf_dir), EVENT_FEATURES))


def woe_bins(spark, sf_dir):
    return rounded(separation.woe_bins(fixture.with_hour(spark, sf_dir), FEATURES))


def feature_report(spark, sf_dir):
    report = separation.feature_report(fixture.with_hour(spark, sf_dir), FEATURES)
    woe = F.col("woe_bins")
    return rounded(
        report.withColumns(
            {"n_woe_bins": F.size(woe).cast("long"), "first_woe": woe[0], "last_woe": F.element_at(woe, -1)}
        ).drop("woe_bins")
    )


def feature_report_bins(spark, sf_dir):
    report = separation.feature_report(fixture.with_hour(spark, sf_dir), FEATURES)
    bins = report.select("feature", F.posexplode("woe_bins").alias("at", "woe"))
    return rounded(bins.select("feature", (F.col("at") + 1).cast("long").alias("bin_id"), "woe"))


def exact_ks_pvalue(spark, sf_dir):
    """The exact p-values of one day, whose positives are few."""
    report = separation.feature_report(slicing.stored_day(fixture.stored(spark, sf_dir), 15), FEATURES, pvalue="exact")
    return rounded(report.select("feature", "ks_statistic", "ks_pvalue"))


def sampled_cliffs_delta(spark, sf_dir):
    df = fixture.with_hour(spark, sf_dir)
    draw = (F.col("Time") * F.lit(7919.0) + F.floor(F.col("Amount") * F.lit(100.0) + F.lit(0.5)).cast("double")) % F.lit(9973.0)
    ordered = draw * F.lit(1e9) + F.col("Time") * F.lit(1e3) + F.col("V1")
    limits = {"max_pos": config.SAMPLED_POSITIVES, "max_neg": config.SAMPLED_NEGATIVES}
    return rounded(separation.sampled_cliffs_delta(df, FEATURES, draw=ordered, **limits))


# --- scores ----------------------------------------------------------------------------------------------------


def pr_auc(spark, sf_dir):
    return rounded(scores.pr_auc(fixture.stored(spark, sf_dir), SCORE, fixture.cuts(spark, sf_dir)))


def capture_rate(spark, sf_dir):
    return rounded(scores.capture_rate(fixture.stored(spark, sf_dir), 0.005, SCORE, fixture.cuts(spark, sf_dir)))


def cost_curve(spark, sf_dir):
    return rounded(scores.cost_curve(fixture.transactions(spark, sf_dir), SCORE), 3)


def optimal_threshold(spark, sf_dir):
    return rounded(scores.optimal_threshold(scores.cost_curve(fixture.transactions(spark, sf_dir), SCORE)), 3)


def imbalance_metrics(spark, sf_dir):
    return _money(scores.imbalance_metrics(fixture.stored(spark, sf_dir), SCORE, cuts=fixture.cuts(spark, sf_dir)))


def _money(df: DataFrame) -> DataFrame:
    losses = ("min_expected_loss", "fn_loss_at_opt", "fp_loss_at_opt", "tp_cost_at_opt")
    return rounded(df).withColumns({c: F.round(c, 3) for c in losses})


def evaluate_scores(spark, sf_dir):
    return rounded(scores.evaluate(fixture.stored(spark, sf_dir), SCORE, cuts=fixture.cuts(spark, sf_dir)))


def daily_kpis(spark, sf_dir):
    return rounded(scores.daily_kpis(fixture.scored(spark, sf_dir)["scoring"]))


def psi(spark, sf_dir):
    parts = fixture.scored(spark, sf_dir)
    return rounded(drift.psi_of_scores(parts["training"], parts["scoring"]))


def psi_by_edges(spark, sf_dir):
    """Scores of positives against all: two clearly different distributions."""
    df = fixture.transactions(spark, sf_dir)
    return rounded(drift.psi_by_edges(df, df.filter(F.col("Class") == 1), "score"))


# --- explanation of a linear stand-in score --------------------------------------------------------------------


def _linear_attributions(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """A linear score's attributions are weight * (value - training mean); for scoring days, plus the means used."""
    parts = fixture.scored(spark, sf_dir)
    means = parts["training"].agg(F.avg("V1").alias("m1"), F.avg("V2").alias("m2"), F.avg("Amount").alias("m3")).first()
    weights = {"V1": (0.4 / 50.0, means["m1"]), "V2": (0.5 / 0.1, means["m2"]), "Amount": (0.1 / 110000.0, means["m3"])}

    def attribution(name: str):
        raw = model.RAW_NAME.get(name, name)
        if raw not in weights:
            return F.lit(0.0)
        weight, mean = weights[raw]
        return F.lit(weight) * (F.col(raw) - F.lit(mean))

    return parts["scoring"].withColumn("attributions", F.array(*[attribution(n) for n in MODEL_FEATURES])), parts["training"]


def linear_global_explain(spark, sf_dir):
    attributed, _ = _linear_attributions(spark, sf_dir)
    return rounded(explain.global_report(explain.global_attributions(attributed, MODEL_FEATURES), AUDIT))


def linear_local_explain(spark, sf_dir):
    return rounded(_linear_local(spark, sf_dir))


def _linear_local(spark, sf_dir) -> DataFrame:
    attributed, _ = _linear_attributions(spark, sf_dir)
    signs = explain.global_attributions(attributed, MODEL_FEATURES)
    risky = explain.high_risk(attributed, ("Time", "Amount", "V1"))
    return explain.local_report(risky, MODEL_FEATURES, signs)


def importance_report(spark, sf_dir):
    """Ranks, shares and flags over stand-in importances taken from the feature moments."""
    return rounded(model.importance_report(_stand_in_importance(spark, sf_dir)))


def _stand_in_importance(spark, sf_dir) -> DataFrame:
    return separation.z_score_diff(fixture.with_hour(spark, sf_dir), FEATURES).select(
        "feature",
        F.abs("z_score_diff").alias("importance_gain"),
        F.col("std_neg").alias("importance_cover"),
        F.abs("mean_neg").alias("importance_weight"),
    )


# --- scorecards and history ------------------------------------------------------------------------------------


def _cards(spark, sf_dir) -> dict[str, DataFrame]:
    parts = fixture.scored(spark, sf_dir)
    attributed, _ = _linear_attributions(spark, sf_dir)
    tables = {
        "separation": separation.feature_separation(fixture.stored(spark, sf_dir), FEATURES, cuts=fixture.cuts(spark, sf_dir)),
        "importance": model.importance_report(_stand_in_importance(spark, sf_dir)),
        "explained": explain.global_report(explain.global_attributions(attributed, MODEL_FEATURES), AUDIT),
        "local": _linear_local(spark, sf_dir),
        "evaluation": scores.evaluate(parts["scoring"]),
        "imbalance": scores.imbalance_metrics(parts["scoring"]),
        "psi": drift.psi_of_scores(parts["training"], parts["scoring"]),
    }
    return {name: stamp(df, RUN_TS) for name, df in tables.items()}


def feature_matrix(spark, sf_dir):
    cards = _cards(spark, sf_dir)
    return rounded(scorecards.feature_matrix(cards["separation"], cards["importance"], cards["explained"]))


def evaluation_matrix(spark, sf_dir):
    cards = _cards(spark, sf_dir)
    return rounded(
        scorecards.evaluation_matrix(
            cards["evaluation"], cards["imbalance"], cards["psi"], cards["importance"], cards["explained"], cards["local"]
        ),
        3,
    )


def _psi_runs(spark, sf_dir) -> tuple[Tables, list[DataFrame]]:
    """Three PSI tables: two of one date from different scores, one of a later date."""
    parts = fixture.scored(spark, sf_dir)
    halves = [parts["scoring"].filter(F.col("Date") <= 15), parts["scoring"].filter(F.col("Date") > 15)]
    runs = [
        stamp(drift.psi_of_scores(parts["training"], halves[0]), RUN_TS),
        stamp(drift.psi_of_scores(parts["training"], halves[1]), "2024-01-15T09:00:00"),
        stamp(drift.psi_of_scores(parts["training"], parts["scoring"]), SECOND_RUN),
    ]
    return fixture.work_tables(spark, "history"), runs


def _run_history(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    tables, runs = _psi_runs(spark, sf_dir)
    for run in runs:
        history.snapshot_history(spark, tables["psi"], tables.history("psi"))
        sources.replace_table(run, tables["psi"])
    return spark.table(tables.history("psi")), spark.table(tables["psi"])


def snapshot_history(spark, sf_dir):
    past, _ = _run_history(spark, sf_dir)
    return rounded(past)


def history_series(spark, sf_dir):
    past, current = _run_history(spark, sf_dir)
    return rounded(history.series(past, current))


def _by_day(df: DataFrame) -> DataFrame:
    """Every slice number stands for a day of January or, from 17 on, of February 2024."""
    day = F.col("Date")
    month = F.when(day <= 16, 1).otherwise(2)
    return df.withColumn("evaluation_date", F.make_date(F.lit(2024), month, F.when(day <= 16, day).otherwise(day - 16)))


def psi_by_day(spark, sf_dir):
    parts = fixture.scored(spark, sf_dir)
    return rounded(drift.psi_by(drift.score_histogram(parts["training"]), drift.score_histogram(parts["scoring"], by=["Date"]), ["Date"]))


def metrics_by_day(spark, sf_dir):
    """All score figures of 31 days from one order of the scores."""
    return _money(scores.metrics_by(fixture.scored(spark, sf_dir)["scoring"]))


def cost_curve_by_day(spark, sf_dir):
    return rounded(scores.cost_curve(fixture.scored(spark, sf_dir)["scoring"], by=["Date"]), 3)


def retrain_trigger(spark, sf_dir):
    """The signals of two months: the PSI of each day, and the PR-AUC of each month over all its transactions."""
    parts = fixture.scored(spark, sf_dir)
    days = _by_day(parts["scoring"])
    histogram = drift.score_histogram(days, by=["evaluation_date"])
    daily_psi = drift.psi_by(drift.score_histogram(parts["training"]), histogram, ["evaluation_date"])
    return rounded(history.retrain_trigger(daily_psi, scores.score_ladder(days, by=["evaluation_date"])))


# --- the trained model: results depend on the trainer, so only the rows are checked ----------------------------


def class_weights(spark, sf_dir):
    return rounded(model.class_weights(fixture.with_hour(spark, sf_dir)))


def train_model(spark, sf_dir):
    _, path = fixture.trained(spark, sf_dir)
    return model.tree_nodes(spark, path)


def _predictions(spark, sf_dir) -> DataFrame:
    fitted, _ = fixture.trained(spark, sf_dir)
    return model.predict(fitted, fixture.stored(spark, sf_dir))


def train_summary(spark, sf_dir):
    """What must hold for any trained ensemble: number of trees, features in range, the rows at every root, and the hessian sum at the
    first, where every row has a quarter of its weight."""
    nodes = train_model(spark, sf_dir)
    splits = F.col("left_child") >= 0
    root = F.when(F.col("node_id") == 0, F.col("n_rows"))
    return nodes.agg(
        F.count_distinct("tree_id").between(1, 50).alias("trees_in_range"),
        F.count_if(splits & ~F.col("feature_index").between(0, len(FEATURES) - 1)).alias("n_unknown_features"),
        F.min(root).alias("least_root_rows"),
        F.max(root).alias("most_root_rows"),
        F.round(F.max(F.when((F.col("node_id") == 0) & (F.col("tree_id") == 0), F.col("cover"))), 3).alias("first_root_cover"),
    )


def predict(spark, sf_dir):
    return _predictions(spark, sf_dir)


def predict_summary(spark, sf_dir):
    """Scored rows per slice and class, those without a probability, and those whose label is not the side of 0.5."""
    p, label = F.col("fraud_probability"), F.col("predicted_Class")
    unscored = p.isNull() | F.isnan(p) | ~p.between(0.0, 1.0)
    counts = (F.count(F.lit(1)).alias("n_rows"), F.count_if(unscored).alias("n_unscored"), F.count_if((p > 0.5).cast("long") != label).alias("n_mislabelled"))
    return _predictions(spark, sf_dir).groupBy("Date", "Class").agg(*counts)


def explain_summary(spark, sf_dir):
    """Transactions whose attributions and base value do not add up to the log-odds of their score."""
    fitted, _ = fixture.trained(spark, sf_dir)
    explained = explain.with_attributions(_predictions(spark, sf_dir), fitted)
    base = explain.base_value(fitted)
    total = F.aggregate("attributions", F.lit(base), lambda a, x: a + x)
    p = F.col("fraud_probability")
    off = F.abs(total - F.ln(p / (F.lit(1.0) - p))) > 1e-6
    return explained.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.coalesce(off, F.lit(True))).alias("n_off"))


def train_small(spark, sf_dir):
    """Two small trees, whose training the SQL repeats step by step."""
    _, path = fixture.trained_small(spark, sf_dir)
    return rounded(model.tree_nodes(spark, path))


def _small_predictions(spark, sf_dir, fitted) -> DataFrame:
    return model.predict(fitted, fixture.stored(spark, sf_dir))


def predict_small(spark, sf_dir):
    fitted, _ = fixture.trained_small(spark, sf_dir)
    p = F.col("fraud_probability")
    figures = (F.sum("predicted_Class").alias("n_detected"), F.avg(p).alias("mean_score"), F.max(p).alias("most_score"))
    return rounded(_small_predictions(spark, sf_dir, fitted).groupBy("Date", "Class").agg(F.count(F.lit(1)).alias("n_rows"), *figures))


def feature_importance_small(spark, sf_dir):
    _, path = fixture.trained_small(spark, sf_dir)
    return rounded(model.feature_importance(spark, path, FEATURES))


def tree_shap_small(spark, sf_dir):
    """The attributions of every scored transaction."""
    fitted, _ = fixture.trained_small(spark, sf_dir)
    explained = explain.with_attributions(_small_predictions(spark, sf_dir, fitted), fitted)
    parts = [F.col("attributions")[i].alias(f"a{i}") for i in range(len(fitted.features))]
    return rounded(explained.select("Time", "Amount", "V1", "fraud_probability", *parts))


def global_explain_small(spark, sf_dir):
    fitted, _ = fixture.trained_small(spark, sf_dir)
    return rounded(explain.global_explain(slicing.split_by_day(fixture.stored(spark, sf_dir))["validation"], fitted, AUDIT))


def local_explain_small(spark, sf_dir):
    fitted, _ = fixture.trained_small(spark, sf_dir)
    overall = explain.global_explain(slicing.split_by_day(fixture.stored(spark, sf_dir))["validation"], fitted, AUDIT)
    return rounded(explain.local_explain(_small_predictions(spark, sf_dir, fitted), overall, fitted))


def slices_of_ties(spark, sf_dir):
    """Rows of day 15, on a table full of ties, that the raw table and the stored slices do not share."""
    tx = fixture.transactions(spark, sf_dir)
    tied = tx.withColumns({"Time": F.floor(F.col("Time") / 36000.0) * F.lit(36000.0), "Amount": F.floor(F.col("Amount") / 20000.0) * F.lit(20000.0)})
    tables = fixture.work_tables(spark, "ties")
    sources.replace_table(slicing.assign_pseudo_day(slicing.add_hour(tied)), tables["converted"], partition_by=("Date",))
    stored_rows = slicing.stored_day(spark.table(tables["converted"]), 15).select(*tied.columns)
    raw = slicing.extract_day(tied, 15).select(*tied.columns)
    differ = raw.exceptAll(stored_rows).unionByName(stored_rows.exceptAll(raw))
    return raw.select(F.lit(0).alias("differs")).unionByName(differ.select(F.lit(1).alias("differs"))).agg(
        F.count_if(F.col("differs") == 0).alias("n_rows"), F.count_if(F.col("differs") == 1).alias("n_differ")
    )


def evaluate_model(spark, sf_dir):
    return scores.evaluate(_predictions(spark, sf_dir))


def feature_importance(spark, sf_dir):
    _, path = fixture.trained(spark, sf_dir)
    return model.feature_importance(spark, path, FEATURES)


def global_explain(spark, sf_dir):
    fitted, _ = fixture.trained(spark, sf_dir)
    return explain.global_explain(slicing.split_by_day(fixture.stored(spark, sf_dir))["validation"], fitted, AUDIT)


def local_explain(spark, sf_dir):
    fitted, _ = fixture.trained(spark, sf_dir)
    return explain.local_explain(_predictions(spark, sf_dir), global_explain(spark, sf_dir), fitted)


def daily_pipeline(spark, sf_dir):
    """A first set-up and two daily runs; the scorecard of the second run."""
    tables = fixture.work_tables(spark, "pipeline")
    fitted, path = fixture.trained(spark, sf_dir)
    sources.replace_table(fixture.transactions(spark, sf_dir), tables["outside"])
    sources.copy_source(spark, tables["outside"], tables["public"])
    initial.build_slices(spark, tables)
    initial.store_model_facts(spark, tables, fitted, path)
    for day, run_ts in ((15, RUN_TS), (16, "2024-01-16T03:00:00")):
        daily.run_daily(spark, tables, path, day, run_ts, FEATURES, AUDIT)
    return spark.table(tables["evaluation_matrix"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        cost_curve,
        optimal_threshold,
        pr_auc,
        capture_rate,
        imbalance_metrics,
        evaluate_scores,
        daily_kpis,
        unpivot_features,
        ks_statistic,
        cliffs_delta,
        z_score_diff,
        information_value,
        information_value_floor,
        feature_separation,
        feature_separation_events,
        woe_bins,
        feature_report,
        feature_report_bins,
        exact_ks_pvalue,
        sampled_cliffs_delta,
        psi,
        psi_by_edges,
        add_hour,
        assign_pseudo_day,
        extract_day,
        split_by_day,
        copy_source,
        overwrite_slice,
        class_weights,
        importance_report,
        linear_global_explain,
        linear_local_explain,
        feature_matrix,
        evaluation_matrix,
        snapshot_history,
        history_series,
        psi_by_day,
        metrics_by_day,
        cost_curve_by_day,
        retrain_trigger,
        train_model,
        predict,
        train_summary,
        predict_summary,
        explain_summary,
        train_small,
        predict_small,
        feature_importance_small,
        tree_shap_small,
        global_explain_small,
        local_explain_small,
        slices_of_ties,
        evaluate_model,
        feature_importance,
        global_explain,
        local_explain,
        daily_pipeline,
    )
}
