"""Order-preserving cells: how a global order is computed without one global task.

A window without PARTITION BY sends every row to a single task. Instead each row gets a *cell*, a number that
never decreases along the sort key. Cells are cut at quantiles of the first key; where one key value is so
frequent that it would fill a cell by itself, that value becomes its own cell and is cut again by the next key.
Ranks and prefix sums are then `offset of the cell + window inside the cell`.

The cut points are plain numbers fixed before the main job, so a task that is run again puts its rows into the
same cells. They only steer the balance of the work: any cut points give the same ranks.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

MAX_CUTS = 8192
MAX_CELLS = 1 << 20
QUANTILE_POINTS = 256
FIRST_SAMPLE = 0.01
SAMPLES_PER_POINT = 16


def slots(spark: SparkSession) -> int:
    """Partitions that ordered rows are spread over."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def target_cells(spark: SparkSession, sharing: int = 1) -> int:
    """Cells per ordered column: two per partition, shared by the columns that are ordered together."""
    return max(8, min(MAX_CUTS, math.ceil(2 * slots(spark) / sharing)))


def n_points(n_cells: int) -> int:
    """Quantiles to look at: a multiple of the cells, and enough to see which values repeat."""
    return n_cells * math.ceil(QUANTILE_POINTS / n_cells)


def quantiles(
    df: DataFrame,
    columns: list[str],
    n_cells: int,
    prepare: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    rate: float = FIRST_SAMPLE,
) -> dict[str, list[float] | None]:
    """Evenly spaced quantiles of each column of `prepare(df)`; one small row on the driver.

    One pass over a sample. Where that sample turns out too small for the cuts, so is the table, and all of it is read.
    """
    n = n_points(n_cells)
    shares = F.expr(f"array({', '.join(f'{i / n!r}D' for i in range(1, n))})")
    found = [F.percentile_approx(c, shares, F.lit(10 * n)).alias(c) for c in columns]
    size = F.count(F.lit(1)).alias("__rows")
    if rate < 1.0:
        row = prepare(df.sample(rate, seed=7)).agg(size, *found).first().asDict()
        if row.pop("__rows") >= SAMPLES_PER_POINT * n:
            return row
    return prepare(df).agg(*found).first().asDict()


@dataclass(frozen=True)
class Cuts:
    """Bucketizer splits of one column, the values that would fill a cell alone, and how much of it repeats."""

    splits: tuple[float, ...]
    hot: tuple[float, ...]
    hot_share: float
    repeated_share: float

    @property
    def tied(self) -> bool:
        """Whether equal values should be combined before they are shuffled."""
        return bool(self.hot) or self.repeated_share > 0.1


def cut_points(found: list[float] | None, n_cells: int) -> Cuts:
    """Every cell gets the same share of the quantiles; a value that spans two cells or more stands alone."""
    points = [q for q in found or [] if q is not None and math.isfinite(q)]
    per_cell = max(1, n_points(n_cells) // n_cells)
    repeats = Counter(points)
    hot = sorted(q for q, times in repeats.items() if times >= max(3, 2 * per_cell))
    cuts = {*points[per_cell - 1 :: per_cell], *hot, *(math.nextafter(q, math.inf) for q in hot)}
    inner = sorted(c for c in cuts if math.isfinite(c)) or [0.0]
    total = max(1, len(points))
    return Cuts(
        (-math.inf, *inner, math.inf),
        tuple(hot),
        sum(repeats[q] for q in hot) / total,
        sum(times for times in repeats.values() if times > 1) / total,
    )


def bucketize(df: DataFrame, splits: dict[str, list[float]], outputs: dict[str, str]) -> DataFrame:
    """Binary-search each column into its splits. NULL comes before the first bucket, NaN after the last."""
    names = list(splits)
    split = Bucketizer(
        splitsArray=[splits[n] for n in names],
        inputCols=names,
        outputCols=[outputs[n] for n in names],
        handleInvalid="keep",
    ).transform(df)
    return split.withColumns({outputs[n]: F.coalesce(F.col(outputs[n]).cast("long") + 1, F.lit(0).cast("long")) for n in names})


def slot_of(turn: Column, spark: SparkSession) -> Column:
    return (turn % F.lit(slots(spark))).cast("int")


def to_slots(df: DataFrame) -> DataFrame:
    """Shuffle rows to the partition named by their slot. Windows by ("slot", ..., "cell") need no further shuffle."""
    return df.repartitionById(slots(df.sparkSession), F.col("slot"))


@dataclass(frozen=True)
class Level:
    key: str
    cuts: Cuts

    @property
    def splits(self) -> tuple[float, ...]:
        return self.cuts.splits

    @property
    def hot(self) -> tuple[float, ...]:
        return self.cuts.hot

    @property
    def width(self) -> int:
        return len(self.splits) + 1


@dataclass(frozen=True)
class Cells:
    """Cut points for a sort key of one or more double columns."""

    levels: tuple[Level, ...]
    keys: tuple[str, ...]

    @property
    def hot_last(self) -> tuple[float, ...]:
        """Values of the last key that still fill a cell alone: copies of one whole key."""
        return self.levels[-1].hot if len(self.levels) == len(self.keys) else ()

    @property
    def tied(self) -> bool:
        """Whether whole keys repeat so much that equal ones should be combined before they are shuffled."""
        return len(self.levels) == len(self.keys) and self.levels[-1].cuts.tied

    def assign(self, df: DataFrame) -> DataFrame:
        """Add `cell`, and the `slot` (partition) it belongs to. The keys must already be clean doubles.

        Cells hold like shares of the rows, so dealing neighbouring cells to the slots in turn balances them.
        """
        outputs = {level.key: f"__bucket_{i}" for i, level in enumerate(self.levels)}
        df = bucketize(df, {level.key: list(level.splits) for level in self.levels}, outputs)
        cell, turn, deeper = F.lit(0).cast("long"), F.lit(0).cast("long"), F.lit(True)
        for level in self.levels:
            own = F.when(deeper, F.col(outputs[level.key])).otherwise(F.lit(0).cast("long"))
            cell, turn = cell * F.lit(level.width) + own, turn + own
            deeper = deeper & F.coalesce(F.col(level.key).isin(*level.hot), F.lit(False)) if level.hot else F.lit(False)
        return df.withColumns({"cell": cell, "slot": slot_of(turn, df.sparkSession)}).drop(*outputs.values())

    def is_hot_key(self) -> Column:
        """True for rows whose whole key is one of the frequent ones."""
        if not self.hot_last:
            return F.lit(False)
        test = F.lit(True)
        for level in self.levels:
            test = test & F.coalesce(F.col(level.key).isin(*level.hot), F.lit(False))
        return test


def plan_cells(
    df: DataFrame, keys: list[str], n_cells: int | None = None, known: Callable[[int], list[float] | None] | None = None
) -> Cells:
    """Find cut points, one small sample per level. A level is only looked at where the one before has frequent values.

    `known` gives evenly spaced quantiles of the first key where they are stored (`sources/sketches.py`), which spares its sample.

    The product of the levels is held near `MAX_CELLS`, which is what bounds the table of cell totals that is
    broadcast later.
    """
    wanted = n_cells or target_cells(df.sparkSession)
    levels: list[Level] = []
    scope, room, rate = df, MAX_CELLS, FIRST_SAMPLE
    for key in keys:
        n = max(2, min(wanted, room))
        found = known(n_points(n)) if known and not levels else None
        cuts = cut_points(found or quantiles(scope.select(key), [key], n, rate=rate)[key], n)
        levels.append(Level(key, cuts))
        if not cuts.hot:
            break
        scope = scope.filter(F.col(key).isin(*cuts.hot))
        rate = min(1.0, rate / cuts.hot_share)
        room = max(2, room // (len(cuts.hot) + 1))
    return Cells(tuple(levels), tuple(keys))


def cell_offsets(totals: DataFrame, measures: list[str], by: list[str], cell: str = "cell") -> DataFrame:
    """Turn per-cell totals into `before_<m>` (sum of earlier cells) and `all_<m>` (sum of all cells).

    `totals` has one row per cell, so the window below runs over at most `MAX_CELLS` rows per group.
    """
    group = Window.partitionBy(*by)
    earlier = group.orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    return totals.select(
        *by,
        cell,
        *[F.coalesce(F.sum(m).over(earlier), zero).alias(f"before_{m}") for m in measures],
        *[F.sum(m).over(group).alias(f"all_{m}") for m in measures],
    )


def count_equal(rows: DataFrame, by: list[str], order: list[str], measures: dict[str, Column], tied: bool) -> tuple[DataFrame, DataFrame]:
    """One row per (by, cell, order) with the given counts, and the totals of every (by, cell).

    With frequent keys, equal rows are combined before the shuffle, and the counts are shuffled again into their cells.
    Without frequent keys combining saves nothing: rows go straight to their cell, where they are counted in place, and
    that one shuffle also serves the window that follows. Either way the totals are taken from the counts, share the
    first shuffle, and include the exact number of distinct keys (`n_values`).
    """
    named = [m.alias(name) for name, m in measures.items()]
    cell = ["slot", *by, "cell"]
    counted = (rows if tied else to_slots(rows)).groupBy(*cell, *order).agg(*named)
    sums = [F.sum(name).alias(name) for name in measures]
    totals = counted.groupBy(*cell).agg(*sums, F.count(F.lit(1)).alias("n_values")).drop("slot")
    return to_slots(counted) if tied else counted, totals


def prefix_counts(
    counted: DataFrame, totals: DataFrame, measures: list[str], by: list[str], order: list[str], few_groups: bool = True
) -> DataFrame:
    """Exclusive prefix sums of `measures` along `order`, for a frame that has one row per (by, cell, order).

    Adds `before_<m>` and `all_<m>`. The offsets of the cells are joined after the window, so they do not travel with
    the rows. `totals` has at most a small multiple of `MAX_CELLS` rows, which bounds the broadcast; where the number of groups
    is not known to be small, Spark chooses the join.
    """
    others = [c for c in totals.columns if c not in (*by, "cell", *measures)]
    offsets = cell_offsets(totals, [*measures, *others], by).drop(*[f"before_{m}" for m in others])
    offsets = offsets.withColumnsRenamed({f"before_{m}": f"__offset_{m}" for m in measures})
    inside = Window.partitionBy("slot", *by, "cell").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    running = counted.withColumns({f"__inside_{m}": F.coalesce(F.sum(m).over(inside), zero) for m in measures})
    joined = running.join(F.broadcast(offsets) if few_groups else offsets, [*by, "cell"])
    summed = {f"before_{m}": F.col(f"__offset_{m}") + F.col(f"__inside_{m}") for m in measures}
    return joined.withColumns(summed).drop(*[f"__{part}_{m}" for m in measures for part in ("offset", "inside")])
