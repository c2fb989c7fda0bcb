"""Times the headline queries and, for some of them, the plain plan they replace. Prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores. Results go to the `noop`
sink, so every row and column is computed but nothing is collected.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from checks import fixture  # noqa: E402
from checks.queries import QUERIES  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = (
    "cost_curve",
    "pr_auc",
    "imbalance_metrics",
    "evaluate_scores",
    "metrics_by_day",
    "ks_statistic",
    "information_value",
    "feature_separation",
    "woe_bins",
    "feature_report",
    "sampled_cliffs_delta",
    "psi",
    "assign_pseudo_day",
    "extract_day",
    "unpivot_features",
    "linear_local_explain",
    "train_model",
    "predict",
    "global_explain",
)
REPEATS = 2

# The same results by one global window, a threshold cross join, or NTILE over single rows.
PLAIN = {
    "cost_curve": """SELECT threshold, sum(if(score < threshold AND Class = 1, Amount + 15D, 0D)) AS fn_loss,
        count_if(score >= threshold AND Class = 0) * 5D AS fp_loss, count_if(score >= threshold AND Class = 1) * 0.1D AS tp_cost
        FROM tx CROSS JOIN (SELECT id / 100D AS threshold FROM range(1, 100)) GROUP BY threshold""",
    "pr_auc": """SELECT sum(if(Class = 1, tp / (tp + fp), 0D)) / max(total) AS pr_auc FROM (
        SELECT Class, sum(Class) OVER w AS tp, sum(1 - Class) OVER w AS fp, sum(Class) OVER () AS total FROM tx
        WINDOW w AS (ORDER BY score DESC, Amount, Class ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""",
    "information_value": """SELECT feature, bin, count_if(Class = 1) AS n_pos, count_if(Class = 0) AS n_neg FROM (
        SELECT Class, feature, ntile(10) OVER (PARTITION BY feature ORDER BY value, Class) AS bin
        FROM txh UNPIVOT (value FOR feature IN (V1, V2, V3, Amount, Hour))) GROUP BY feature, bin""",
    "assign_pseudo_day": "SELECT *, (row_number() OVER (ORDER BY Time, Amount, V1) - 1) % 50 + 1 AS Date FROM txh",
    "extract_day": "SELECT * FROM (SELECT *, (row_number() OVER (ORDER BY Time, Amount, V1) - 1) % 50 + 1 AS Date FROM txh) WHERE Date = 15",
    "evaluate_scores": """SELECT max(tp), max(fp), max(loss), (sum(if(Class = 1, mid, 0D)) - max(n) * (max(n) + 1) / 2) / (max(n) * (count(*) - max(n))) AS roc_auc
        FROM (SELECT Class, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS mid, sum(Class) OVER () AS n,
        sum(if(score >= 0.5 AND Class = 1, 1, 0)) OVER () AS tp, sum(if(score >= 0.5 AND Class = 0, 1, 0)) OVER () AS fp,
        avg(-if(Class = 1, ln(score), ln(1 - score))) OVER () AS loss FROM tx)""",
    "metrics_by_day": """SELECT Date, sum(if(Class = 1, tp / (tp + fp), 0D)) / max(total) AS pr_auc FROM (
        SELECT Date, Class, sum(Class) OVER w AS tp, sum(1 - Class) OVER w AS fp, sum(Class) OVER (PARTITION BY Date) AS total FROM tx
        WINDOW w AS (PARTITION BY Date ORDER BY score DESC, Amount, Class ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) GROUP BY Date""",
}


def timed(make) -> float:
    best = float("inf")
    for _ in range(REPEATS):
        start = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        best = min(best, time.perf_counter() - start)
    return round(best, 3)


def main() -> None:
    work = tempfile.mkdtemp(prefix="ledgerwatch-bench-")
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", f"{work}/warehouse")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    fixture.stored(spark, SF_DIR).createOrReplaceTempView("tx")
    fixture.with_hour(spark, SF_DIR).select("*").withColumn("Hour", fixture.F.col("Hour").cast("double")).createOrReplaceTempView("txh")

    start = time.perf_counter()
    fixture.trained(spark, SF_DIR)
    fit = round(time.perf_counter() - start, 3)
    queries = {name: timed(lambda q=QUERIES[name]: q(spark, SF_DIR)) for name in HEADLINE}
    queries["train_model"] = fit
    plain = {name: timed(lambda s=text: spark.sql(s)) for name, text in PLAIN.items()}
    print(
        json.dumps(
            {
                "metric": "headline queries, total seconds",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
                "cpus": int(CPUS),
                "plain": plain,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
