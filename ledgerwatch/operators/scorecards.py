"""The two long-format scorecards: one row per feature and metric, one row per model metric.

Each source table is read once and turned long with an array of structs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwatch import config
from ledgerwatch.operators.scores import merge_single_rows

STAMPS = ("evaluation_date", "evaluated_at")

# Category names and display labels of the scorecards.
SEPARATION = (1, "① 分布乖離・判別力")
EXPLANATION = (2, "② BQML 固有説明性")
PERFORMANCE = (3, "③ 予測性能・不均衡適応")
STABILITY = (4, "④ 安定性・経時変化")
RECORDED, AUDIT_OK, AUDIT_CHECK, OVERFIT = "記録", "監査OK", "監査要確認", "過学習疑い"
MINIMIZED, REFERENCE_ONLY, INCONSISTENT = "最小化済み", "参考値", "要確認"
LABELS = {
    "ks_statistic": "KS統計量",
    "information_value": "IV (Information Value)",
    "cliffs_delta": "Cliff's Delta (|δ|)",
    "z_score_diff": "Zスコア差 (|ΔZ|)",
    "importance_gain": "ML.FEATURE_IMPORTANCE (Gain)",
    "importance_cover": "ML.FEATURE_IMPORTANCE (Cover)",
    "mean_abs_shap": "ML.GLOBAL_EXPLAIN (Tree SHAP)",
    "pr_auc": "PR-AUC",
    "capture_rate_0_1pct": "Top-0.1% Capture Rate",
    "capture_rate_0_5pct": "Top-0.5% Capture Rate",
    "cost_sensitive_expected_loss": "Cost-Sensitive Expected Loss",
    "optimal_threshold": "最適閾値 P*",
    "psi": "PSI (Population Stability Index)",
    "top5_gain_share": "上位5変数 Gain 占有率",
    "audit_vars_in_shap_top5": "監査変数の Tree SHAP 上位5入り件数",
    "local_shap_direction_consistency": "局所 SHAP 寄与方向の整合率",
    "roc_auc": "ROC-AUC (参考値)",
    "precision": "Precision (参考値)",
    "recall": "Recall (参考値)",
    "f1_score": "F1スコア (参考値)",
}


def _text(value: str | Column) -> Column:
    return F.lit(value) if isinstance(value, str) else value


def _feature_entry(category, metric: str, value: str, rating, rank: str | None, flagged) -> Column:
    return F.struct(
        F.lit(category[0]).cast("long").alias("category_id"),
        F.lit(category[1]).alias("category_name"),
        F.lit(metric).alias("metric_name"),
        F.lit(LABELS[metric]).alias("metric_label"),
        F.col(value).cast("double").alias("metric_value"),
        _text(rating).alias("rating"),
        (F.col(rank) if rank else F.lit(None)).cast("long").alias("rank_value"),
        (F.lit(flagged) if isinstance(flagged, bool) else flagged).alias("is_flagged"),
    )


def _long(table: DataFrame, keys: list[str], entries: list[Column]) -> DataFrame:
    return table.select(*keys, F.explode(F.array(*entries)).alias("entry")).select(*keys, "entry.*")


def feature_matrix(separation: DataFrame, importance: DataFrame, explained: DataFrame) -> DataFrame:
    """Seven metrics per feature, with rating, rank and flag."""
    keys = [*STAMPS, "feature"]
    rank, audited = F.col("rank_shap"), F.col("is_audit_variable")
    overfit = F.col("cover_overfit_flag")
    overfit_rating = F.when(overfit, F.lit(OVERFIT)).otherwise(F.lit(RECORDED))
    audit_rating = (
        F.when(audited & (rank <= 5), F.lit(AUDIT_OK)).when(audited & (rank > 5), F.lit(AUDIT_CHECK)).otherwise(F.lit(RECORDED))
    )
    parts = [
        _long(
            separation,
            keys,
            [
                _feature_entry(
                    SEPARATION, "ks_statistic", "ks_statistic", F.col("ks_rating"), None, F.col("ks_rating") == "分離能不足"
                ),
                _feature_entry(
                    SEPARATION,
                    "information_value",
                    "information_value",
                    F.col("iv_rating"),
                    None,
                    F.col("iv_rating").isin("無効変数", "過学習疑い"),
                ),
                _feature_entry(
                    SEPARATION,
                    "cliffs_delta",
                    "cliffs_delta_abs",
                    F.col("cliffs_rating"),
                    None,
                    F.col("cliffs_rating") == "Negligible",
                ),
                _feature_entry(SEPARATION, "z_score_diff", "z_score_diff_abs", F.col("z_rating"), None, False),
            ],
        ),
        _long(
            importance,
            keys,
            [
                _feature_entry(EXPLANATION, "importance_gain", "importance_gain", overfit_rating, "rank_gain", False),
                _feature_entry(EXPLANATION, "importance_cover", "importance_cover", overfit_rating, "rank_cover", overfit),
            ],
        ),
        _long(
            explained,
            keys,
            [
                _feature_entry(
                    EXPLANATION, "mean_abs_shap", "abs_attribution", audit_rating, "rank_shap", audited & (rank > 5)
                )
            ],
        ),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _model_entry(order: int, category, metric: str, value, rating, passed, limit=None, warn=None) -> Column:
    return F.struct(
        F.lit(category[0]).cast("long").alias("category_id"),
        F.lit(category[1]).alias("category_name"),
        F.lit(metric).alias("metric_name"),
        F.lit(LABELS[metric]).alias("metric_label"),
        (F.col(value) if isinstance(value, str) else value).cast("double").alias("metric_value"),
        F.lit(limit).cast("double").alias("threshold_pass"),
        F.lit(warn).cast("double").alias("threshold_warn"),
        _text(rating).alias("rating"),
        (F.lit(passed) if isinstance(passed, bool) else passed).alias("is_pass"),
        F.lit(order).cast("long").alias("sort_order"),
    )


def evaluation_matrix(
    evaluation: DataFrame,
    imbalance: DataFrame,
    psi: DataFrame,
    importance: DataFrame,
    explained: DataFrame,
    local: DataFrame,
) -> DataFrame:
    """Thirteen model metrics with limits, rating and pass flag. Inputs are the stamped evaluation tables."""
    keys = list(STAMPS)
    first_capture, second_capture = config.CAPTURE_PASS

    def passes(rating: str) -> Column:
        return F.col(rating) == "PASS"

    performance = _long(
        imbalance,
        keys,
        [
            _model_entry(1, PERFORMANCE, "pr_auc", "pr_auc", F.col("pr_auc_rating"), passes("pr_auc_rating"), config.PR_AUC_PASS),
            _model_entry(
                2, PERFORMANCE, "capture_rate_0_1pct", "capture_rate_0_1pct", F.col("capture_0_1_rating"), passes("capture_0_1_rating"), first_capture
            ),
            _model_entry(
                3, PERFORMANCE, "capture_rate_0_5pct", "capture_rate_0_5pct", F.col("capture_0_5_rating"), passes("capture_0_5_rating"), second_capture
            ),
            _model_entry(4, PERFORMANCE, "cost_sensitive_expected_loss", "min_expected_loss", MINIMIZED, True),
            _model_entry(5, PERFORMANCE, "optimal_threshold", "optimal_threshold", RECORDED, True),
        ],
    )
    drift = _long(
        psi.groupBy(*keys).agg(F.any_value("psi").alias("psi"), F.any_value("psi_rating").alias("psi_rating")),
        keys,
        [
            _model_entry(
                6, STABILITY, "psi", "psi", F.col("psi_rating"), F.col("psi_rating") == "Green", config.PSI_WARN, config.PSI_ALARM
            )
        ],
    )
    concentrated = F.col("top5_gain_concentrated")
    gain = _long(
        importance.groupBy(*keys).agg(
            F.any_value("top5_gain_share").alias("top5_gain_share"),
            F.any_value("top5_gain_concentrated").alias("top5_gain_concentrated"),
        ),
        keys,
        [
            _model_entry(
                7,
                EXPLANATION,
                "top5_gain_share",
                "top5_gain_share",
                F.when(concentrated, F.lit("PASS")).otherwise(F.lit("FAIL")),
                concentrated,
                config.TOP_GAIN_SHARE,
            )
        ],
    )
    audited = F.col("is_audit_variable")
    all_in = F.col("in_top5") == F.col("present")
    audit = _long(
        explained.groupBy(*keys).agg(
            F.count_if(audited & (F.col("rank_shap") <= 5)).alias("in_top5"), F.count_if(audited).alias("present")
        ),
        keys,
        [
            _model_entry(
                8,
                EXPLANATION,
                "audit_vars_in_shap_top5",
                "in_top5",
                F.when(all_in, F.lit(AUDIT_OK)).otherwise(F.lit(AUDIT_CHECK)),
                all_in,
                3.0,
            )
        ],
    )
    steady = F.col("consistency") >= F.lit(config.LOCAL_CONSISTENCY)
    local_rows = _long(
        local.groupBy(*keys).agg(
            F.try_divide(F.count_if(F.col("direction_consistent")), F.count(F.lit(1))).alias("consistency")
        ),
        keys,
        [
            _model_entry(
                9,
                EXPLANATION,
                "local_shap_direction_consistency",
                "consistency",
                F.when(steady, F.lit("PASS")).otherwise(F.lit(INCONSISTENT)),
                steady,
                config.LOCAL_CONSISTENCY,
            )
        ],
    )
    names = ("roc_auc", "precision", "recall", "f1_score")
    # The reference figures carry the stamps of the imbalance row; one row per run on both sides.
    figures = merge_single_rows(evaluation.select(*names), imbalance.select(*keys))
    reference = _long(
        figures, keys, [_model_entry(10 + i, PERFORMANCE, n, n, REFERENCE_ONLY, True) for i, n in enumerate(names)]
    )
    result = performance
    for part in (drift, gain, audit, local_rows, reference):
        result = result.unionByName(part)
    return result
