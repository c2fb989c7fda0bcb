"""Pseudo-days: a repeatable split of the transaction table into 50 slices, and the columns derived from time."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerwatch import config
from ledgerwatch.functions.columns import clean_double
from ledgerwatch.operators import ordering
from ledgerwatch.session import use_checkpoint_dir

COPIES_PER_CHUNK = 100_000


def default_day(now: datetime | None = None, override: str | None = None) -> int:
    """The slice to run: the override if given, else today's day of month in the business time zone."""
    if override is not None and override.strip():
        try:
            day = int(override)
        except ValueError as wrong:
            raise ValueError(f"day must be an integer, got {override!r}") from wrong
    else:
        zone = ZoneInfo(config.BUSINESS_TIMEZONE)
        day = (now.astimezone(zone) if now else datetime.now(zone)).day
    return check_day(day)


def check_day(day: int) -> int:
    if not 1 <= day <= config.SLICE_COUNT:
        raise ValueError(f"day must be between 1 and {config.SLICE_COUNT}, got {day}")
    return day


def add_hour(df: DataFrame, time: str = "Time") -> DataFrame:
    """Hour of day 0..23 from elapsed seconds; rows without a time are dropped."""
    hour = F.floor(F.col(time).cast("double") / F.lit(3600.0)) % F.lit(24)
    return df.filter(F.col(time).isNotNull()).withColumn("Hour", hour.cast("long"))


DERIVED = ("Hour", "Date")


def tie_columns(df: DataFrame) -> list[str]:
    """The columns that rank rows with equal order keys: those of the source, by name, without the derived ones."""
    return sorted(c for c in df.columns if c not in DERIVED and _orderable(df, c))


def assign_pseudo_day(
    df: DataFrame,
    n: int = config.SLICE_COUNT,
    order: Sequence[str] = config.SLICE_ORDER,
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """Deal rows round-robin to `n` slices in global order: Date = (rank - 1) mod n + 1.

    Rows equal on `order` are ranked by a hash of the `tie_break` columns, then by those columns (default `tie_columns`).
    So a row's slice depends neither on how the input is split, nor on the order of its columns, nor on derived columns:
    a table sliced before and after `add_hour` gets the same slices. The hash spreads frequent keys over cells. Rank inside an order cell is a window; the cells before it come from a small broadcast.
    Cells that hold copies of one and the same row are collapsed to a count first and written out again in chunks.
    A sample is read while the plan is built.
    """
    ties = list(tie_break) if tie_break is not None else tie_columns(df)
    return _dealt(df, n, order, ties, F.xxhash64(*[F.col(f"`{c}`") for c in ties])).select(*df.columns, "Date")


def _dealt(df: DataFrame, n: int, order: Sequence[str], ties: list[str], row_hash: Column) -> DataFrame:
    """The rows of `df` with Date, and with `__copies`, the number of rows equal to theirs in order, hash and ties."""
    source = list(df.columns)
    rows = df.filter(F.col(order[0]).isNotNull())
    keys = [f"__key_{i}" for i in range(len(order))]
    keyed = rows.withColumns({k: clean_double(c) for k, c in zip(keys, order)})
    keyed = keyed.withColumn("__row_hash", row_hash)
    keyed = keyed.withColumn("__hash_key", F.col("__row_hash").cast("double"))
    cells = ordering.plan_cells(keyed, [*keys, "__hash_key"])
    celled = cells.assign(keyed)

    totals = celled.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    offsets = ordering.cell_offsets(totals, ["n"], []).select("cell", "before_n")
    position = [*keys, "__row_hash", *ties]

    copies = cells.is_hot_key()
    single = celled if not cells.hot_last else celled.filter(~copies)
    inside = F.row_number().over(Window.partitionBy("slot", "cell").orderBy(*position))
    equal = F.count(F.lit(1)).over(Window.partitionBy("slot", "cell", *position))
    ranked = ordering.to_slots(single).withColumns({"__inside": inside.cast("long"), "__copies": equal}).join(F.broadcast(offsets), "cell")
    dated = ranked.withColumn("Date", _slice(F.col("before_n") + F.col("__inside") - 1, n))
    result = dated.select(*source, "Date", "__copies")
    if cells.hot_last:
        result = result.unionByName(_deal_copies(celled.filter(copies), offsets, source, position, n))
    return result


def _orderable(df: DataFrame, column: str) -> bool:
    return df.schema[column].dataType.typeName() not in ("map", "variant")


def _slice(rank: Column, n: int) -> Column:
    return (rank % F.lit(n) + 1).cast("int")


def _deal_copies(rows: DataFrame, offsets: DataFrame, source: list[str], position: list[str], n: int) -> DataFrame:
    """Slice numbers for rows that occur very often: count the copies, rank the counts, write the copies out again."""
    helpers = [c for c in position if c not in source]
    counted = rows.groupBy("cell", *helpers, *source).agg(F.count(F.lit(1)).alias("__copies"))
    earlier = Window.partitionBy("cell").orderBy(*position).rowsBetween(Window.unboundedPreceding, -1)
    first = counted.withColumn("__inside", F.coalesce(F.sum("__copies").over(earlier), F.lit(0).cast("long")))
    first = first.join(F.broadcast(offsets), "cell").withColumn("__start", F.col("before_n") + F.col("__inside"))
    step = F.lit(COPIES_PER_CHUNK).cast("long")
    chunked = first.withColumn("__from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__copies") - 1, step)))
    spread = chunked.repartition("__from", "__row_hash")
    until = F.least(F.col("__from") + step, F.col("__copies")) - 1
    each = spread.withColumn("__copy", F.explode(F.sequence(F.col("__from"), until)))
    return each.withColumn("Date", _slice(F.col("__start") + F.col("__copy"), n)).select(*source, "Date", "__copies")


ROW_KEY = ("__row_hash_a", "__row_hash_b")
BROADCAST_KEYS = 1_000_000


def _row_key(df: DataFrame) -> list[Column]:
    ties = [F.col(f"`{c}`") for c in tie_columns(df)]
    return [F.xxhash64(*ties).alias(ROW_KEY[0]), F.xxhash64(F.lit(1), *ties).alias(ROW_KEY[1])]


def order_index(df: DataFrame, n: int = config.SLICE_COUNT, order: Sequence[str] = config.SLICE_ORDER) -> DataFrame:
    """(row key, Date, n_rows, copies): for each row, named by 128 bits of hash, the slices that its copies are dealt to.

    Only the order columns and the hashes are ordered and shuffled. Store it to take many slices out of one raw table.
    """
    narrow = df.select(*order, *_row_key(df))
    dealt = _dealt(narrow, n, order, [ROW_KEY[1]], F.col(ROW_KEY[0]))
    return dealt.groupBy(*ROW_KEY, "Date").agg(F.count(F.lit(1)).alias("n_rows"), F.max("__copies").alias("copies"))


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = f"{use_checkpoint_dir(df.sparkSession)}/{name}_{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def extract_day(df: DataFrame, day: int, index: DataFrame | None = None) -> DataFrame:
    """One slice of a raw table. A table that is stored by `Date` should be read with `stored_day` instead.

    The slice is chosen on narrow keys (`order_index`, or a stored one) and written to the shared folder, which runs while the
    plan is built. The rows themselves are then read once and matched with it where they are: up to BROADCAST_KEYS
    chosen keys are broadcast, beyond that Spark joins them.
    """
    found = index if index is not None else order_index(df)
    chosen = _kept(found.filter(F.col("Date") == check_day(day)).drop("Date"), "chosen_rows")
    if chosen.count() <= BROADCAST_KEYS:
        chosen = F.broadcast(chosen)
    rows = df.select("*", *_row_key(df)).join(chosen, list(ROW_KEY))
    names = [F.col(f"`{c}`") for c in df.columns]
    out = rows.filter(F.col("n_rows") == F.col("copies")).select(*names)
    if not chosen.filter(F.col("n_rows") < F.col("copies")).isEmpty():  # copies of one row in several slices: this one's share
        one = rows.filter(F.col("n_rows") < F.col("copies")).dropDuplicates(list(ROW_KEY))
        first = F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_rows"), F.lit(COPIES_PER_CHUNK).cast("long"))).alias("__from")
        chunks = one.select("*", first).repartition("__from", *ROW_KEY)
        last = F.least(F.col("__from") + F.lit(COPIES_PER_CHUNK - 1), F.col("n_rows"))
        out = out.unionByName(chunks.withColumn("__copy", F.explode(F.sequence("__from", last))).select(*names))
    return out.withColumn("Date", F.lit(day))


def stored_day(sliced: DataFrame, day: int) -> DataFrame:
    """One slice of a table stored partitioned by `Date`: the scan reads that partition only."""
    return sliced.filter(F.col("Date") == check_day(day))


def split_by_day(df: DataFrame) -> dict[str, DataFrame]:
    ranges = {
        "scoring": config.SCORING_DAYS,
        "validation": config.VALIDATION_DAYS,
        "training": config.TRAINING_DAYS,
    }
    return {name: df.filter(F.col("Date").between(*days)) for name, days in ranges.items()}
