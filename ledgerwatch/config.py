"""Names and limits every operator reads. Nothing here touches Spark."""

from __future__ import annotations

from dataclasses import dataclass

# Column names, slice ranges, cost constants and rating limits that results must agree on.
PCA_FEATURES = tuple(f"V{i}" for i in range(1, 29))
FEATURES = PCA_FEATURES + ("Amount", "Hour")
AUDIT_FEATURES = ("V14", "V17", "V12")
SLICE_ORDER = ("Time", "Amount", "V1")
SLICE_COUNT = 50
SCORING_DAYS = (1, 31)
VALIDATION_DAYS = (32, 36)
TRAINING_DAYS = (37, 50)
BUSINESS_TIMEZONE = "Asia/Tokyo"

CHARGEBACK_FEE = 15.0
FALSE_ALARM_COST = 5.0
REVIEW_COST = 0.1
THRESHOLDS = tuple(i / 100 for i in range(1, 100))

CAPTURE_SHARES = (0.001, 0.005)
NTILES = 10
WOE_SMOOTHING = 0.5
Z_EPSILON = 1e-9
PSI_BINS = 10
PSI_FLOOR = 0.0001
STRONG_KS = 0.40
STRONG_DELTA = 0.33
TOP_GAIN_FEATURES = 5
TOP_GAIN_SHARE = 0.60
OVERFIT_COVER_SHARE = 0.005
OVERFIT_GAIN_SHARE = 0.05
EXPLAIN_SCORE = 0.85
EXPLAIN_TOP_ROWS = 20
EXPLAIN_TOP_FEATURES = 5
LOCAL_CONSISTENCY = 0.80
PR_AUC_PASS = 0.80
CAPTURE_PASS = (0.75, 0.90)
PSI_WARN = 0.10
PSI_ALARM = 0.25
MAX_TREES = 50
SAMPLED_POSITIVES = 500
SAMPLED_NEGATIVES = 1000


@dataclass(frozen=True)
class ScoreColumns:
    """Where a scored table keeps its label, amount and probability."""

    label: str = "Class"
    amount: str = "Amount"
    score: str = "fraud_probability"
