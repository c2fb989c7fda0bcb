"""Quantile sketches that are stored beside a table, one per column and group, and merged when they are read.

Orders over a table need cut points (`operators/ordering.py`). With stored sketches they come from a few small rows, for any range
of days, where else a sample of the table is read first. Cut points only balance the work: results do not depend on them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.functions.columns import clean_double, is_finite

SIZE = 1024


def sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ("Date",)) -> DataFrame:
    """(group, column, sketch): a mergeable sketch of the finite values of each column in each group, from one pass.

    A sketch has a few kilobytes, whatever the number of rows. Columns without finite values have none.
    """
    def of(column: str):
        value = clean_double(column)
        return F.kll_sketch_agg_double(F.when(is_finite(value), value), SIZE)

    wide = df.groupBy(*by).agg(*[of(c).alias(f"s{i}") for i, c in enumerate(columns)])
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"s{i}").alias("sketch")) for i, c in enumerate(columns)])
    long = wide.select(*by, F.inline(entries))
    return long.filter(F.kll_sketch_get_n_double("sketch") > 0)


def points(stored: DataFrame, columns: Sequence[str], n: int) -> dict[str, list[float]]:
    """The n - 1 evenly spaced quantiles of each column over all groups of `stored`; one row per column reaches the driver."""
    ranks = F.array(*[F.lit(i / n) for i in range(1, n)])
    merged = stored.filter(F.col("column").isin(*columns)).groupBy("column").agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    return {r.column: list(r.q) for r in merged.select("column", F.kll_sketch_get_quantile_double("sketch", ranks).alias("q")).collect()}
