"""Table names of one installation."""

from __future__ import annotations

from dataclasses import dataclass

# The evaluation tables that keep a history.
WITH_HISTORY = (
    "evaluation",
    "feature_separation",
    "woe_bins",
    "feature_importance",
    "global_explain",
    "local_explain",
    "imbalance_metrics",
    "cost_curve",
    "psi",
)
# Kept by date as well: what a month's figures are pooled from.
POOLED = ("score_ladder",)


@dataclass(frozen=True)
class Tables:
    """`catalog.schema.prefix + name`; history tables carry their own prefix."""

    schema: str
    catalog: str = "spark_catalog"
    prefix: str = ""
    history_prefix: str = "v_detection_"

    def __getitem__(self, name: str) -> str:
        return f"{self.catalog}.{self.schema}.{self.prefix}{name}"

    def history(self, name: str) -> str:
        return f"{self.catalog}.{self.schema}.{self.history_prefix}{name}"
