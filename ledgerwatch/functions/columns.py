"""Small column helpers."""

from __future__ import annotations

from datetime import datetime, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwatch import config


def clean_double(name: str) -> Column:
    """The column as a double with -0.0 folded into 0.0, so equal values share one bucket."""
    value = F.col(name).cast("double")
    return F.when(value == 0, F.lit(0.0)).otherwise(value)


def is_finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) != F.lit(float("inf")))


def count_where(test: Column) -> Column:
    return F.sum(F.when(test, F.lit(1).cast("long")).otherwise(F.lit(0).cast("long")))


def label_is(name: str, value: int) -> Column:
    return F.col(name).cast("long") == F.lit(value)


def as_instant(run_ts: datetime | str) -> datetime:
    """A run time as an aware instant; a naive one is read as UTC."""
    moment = datetime.fromisoformat(run_ts) if isinstance(run_ts, str) else run_ts
    return moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)


def stamp(df: DataFrame, run_ts: datetime | str) -> DataFrame:
    """Put the evaluation date (business time zone) and the instant in front of a table."""
    moment = as_instant(run_ts)
    micros = round(moment.timestamp() * 1_000_000)
    return df.select(
        F.lit(moment.astimezone(ZoneInfo(config.BUSINESS_TIMEZONE)).date()).alias("evaluation_date"),
        F.timestamp_micros(F.lit(micros)).alias("evaluated_at"),
        *[F.col(f"`{c}`") for c in df.columns],
    )
