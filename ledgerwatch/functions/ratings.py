"""Rating labels. One ladder per metric, used by every table that shows the metric."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (lower limit, label) from best to worst, then the label below all limits.
KS_LADDER = (((0.50, "卓越"), (0.40, "優秀"), (0.20, "許容")), "分離能不足")
IV_LADDER = (((0.50, "過学習疑い"), (0.30, "強い予測力"), (0.10, "中程度"), (0.02, "弱い予測力")), "無効変数")
DELTA_LADDER = (((0.474, "Large"), (0.330, "Medium"), (0.147, "Small")), "Negligible")
Z_LADDER = (((3.0, "有意 (参考)"),), "参考値未満")
PR_AUC_LADDER = (((0.80, "PASS"),), "FAIL")
CAPTURE_0_1_LADDER = (((0.75, "PASS"),), "FAIL")
CAPTURE_0_5_LADDER = (((0.90, "PASS"),), "FAIL")
PSI_LADDER = (((0.25, "Red"), (0.10, "Yellow")), "Green")
NO_POSITIVES = "データ不足"


def _climb(value: Column, ladder) -> Column:
    steps, below = ladder
    rating = None
    for limit, label in steps:
        test = value >= F.lit(limit)
        rating = F.when(test, F.lit(label)) if rating is None else rating.when(test, F.lit(label))
    return rating.otherwise(F.lit(below))


def rate_ks(value: Column) -> Column:
    return _climb(value, KS_LADDER)


def rate_iv(value: Column) -> Column:
    return _climb(value, IV_LADDER)


def rate_cliffs(value: Column) -> Column:
    return _climb(F.abs(value), DELTA_LADDER)


def rate_z(value: Column) -> Column:
    return _climb(F.abs(value), Z_LADDER)


def rate_pr_auc(value: Column) -> Column:
    return _climb(value, PR_AUC_LADDER)


def rate_capture_0_1(value: Column) -> Column:
    return _climb(value, CAPTURE_0_1_LADDER)


def rate_capture_0_5(value: Column) -> Column:
    return _climb(value, CAPTURE_0_5_LADDER)


def rate_psi(value: Column) -> Column:
    """A missing PSI rates as the worst light, as an unordered comparison would."""
    return F.when(value.isNull(), F.lit("Red")).otherwise(_climb(value, PSI_LADDER))


def unless_no_positives(n_pos: Column, rating: Column) -> Column:
    return F.when(n_pos == 0, F.lit(NO_POSITIVES)).otherwise(rating)
