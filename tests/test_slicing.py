from collections import Counter
from datetime import datetime, timezone

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerwatch.operators import ordering, slicing

SCHEMA = "Time double, Amount double, V1 double, Class int"


def make(spark, rows, parts=6):
    return spark.createDataFrame([(float(t), float(a), float(v), int(c)) for t, a, v, c in rows], SCHEMA).repartition(parts)


def rank_days(rows, n=50):
    return Counter((*r, i % n + 1) for i, r in enumerate(sorted(rows)))


def random_rows(n, seed=1, times=10**6):
    rng = np.random.default_rng(seed)
    return [(float(rng.integers(0, times)), float(rng.integers(0, 10**6)), float(rng.normal()), 0) for _ in range(n)]


def dealt(df):
    return Counter(tuple(r) for r in slicing.assign_pseudo_day(df).collect())


def test_unique_keys_follow_the_global_order(spark):
    rows = random_rows(2000)
    assert dealt(make(spark, rows)) == rank_days(rows)


@pytest.mark.parametrize("levels", ["time", "amount"])
def test_a_third_of_rows_at_one_key_value(spark, levels):
    rows = random_rows(1500)
    hot = random_rows(900, seed=2)
    rows += [(500.0, a if levels == "time" else 7.0, v, c) for _, a, v, c in hot]
    assert dealt(make(spark, rows)) == rank_days(rows)


def test_copies_of_one_row_are_dealt_in_turn(spark):
    rows = random_rows(1000) + [(500.0, 7.0, 1.5, 1)] * 1103
    df = make(spark, rows)
    assert ordering.plan_cells(df, ["Time", "Amount", "V1"]).hot_last
    assert dealt(df) == rank_days(rows)


def test_copies_are_written_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(slicing, "COPIES_PER_CHUNK", 64)
    rows = random_rows(300) + [(500.0, 7.0, 1.5, 1)] * 701
    assert dealt(make(spark, rows)) == rank_days(rows)


def test_result_does_not_depend_on_the_input_split(spark):
    rows = [(float(i % 7), 1.0, 2.0, i % 2) for i in range(600)]
    assert dealt(make(spark, rows, 2)) == dealt(make(spark, rows, 9))


def test_rows_without_time_are_dropped_and_days_are_even(spark):
    df = make(spark, random_rows(500)).unionByName(spark.createDataFrame([(None, 1.0, 1.0, 0)] * 3, SCHEMA))
    sizes = slicing.assign_pseudo_day(df).groupBy("Date").count().collect()
    assert len(sizes) == 50 and {r["count"] for r in sizes} == {10}


def test_missing_second_key_sorts_first(spark):
    rows = [(1.0, float(i), 0.0, 0) for i in range(60)]
    df = make(spark, rows).unionByName(spark.createDataFrame([(1.0, None, 0.0, 0)], SCHEMA))
    days = {r.Amount: r.Date for r in slicing.assign_pseudo_day(df).collect()}
    assert days[None] == 1 and days[0.0] == 2 and days[59.0] == 11


def test_window_is_partitioned(spark):
    plan = slicing.assign_pseudo_day(make(spark, random_rows(200)))._jdf.queryExecution().executedPlan().toString()
    rows_window = [line for line in plan.split("\n") if "row_number" in line and "Window" in line]
    assert rows_window and all("[slot" in line and "cell" in line for line in rows_window)
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_extract_and_split(spark):
    df = make(spark, random_rows(500))
    assert slicing.extract_day(df, 7).count() == 10
    parts = slicing.split_by_day(slicing.assign_pseudo_day(df))
    assert {n: p.count() for n, p in parts.items()} == {"scoring": 310, "validation": 50, "training": 140}
    for bad in (0, 51, 99):
        with pytest.raises(ValueError):
            slicing.extract_day(df, bad)


def test_default_day():
    late = datetime(2024, 1, 30, 16, 0, tzinfo=timezone.utc)
    assert slicing.default_day(late) == 31 and slicing.default_day(late, "  ") == 31
    assert slicing.default_day(late, "1") == 1 and slicing.default_day(late, "50") == 50
    for bad in ("0", "51", "99", "today"):
        with pytest.raises(ValueError):
            slicing.default_day(late, bad)


def test_add_hour(spark):
    df = spark.createDataFrame([(0.0,), (3599.9,), (3600.0,), (86399.0,), (90000.0,), (None,)], "Time double")
    assert [r.Hour for r in slicing.add_hour(df).orderBy("Time").collect()] == [0, 0, 1, 23, 1]
    assert dict(slicing.add_hour(df).dtypes)["Hour"] == "bigint"


def test_stored_day_reads_one_partition(spark):
    sliced = slicing.assign_pseudo_day(make(spark, random_rows(500)))
    sliced.write.mode("overwrite").partitionBy("Date").saveAsTable("stored_slices")
    plan = slicing.stored_day(spark.table("stored_slices"), 9)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Date" in plan


def test_ties_get_the_same_slice_with_and_without_derived_columns(spark):
    df = spark.range(2000).select(
        F.lit(60.0).alias("Time"), F.lit(5.0).alias("Amount"), F.lit(1.0).alias("V1"), F.col("id").cast("double").alias("V2")
    )
    plain = {r.V2: r.Date for r in slicing.assign_pseudo_day(df).collect()}
    with_hour = {r.V2: r.Date for r in slicing.assign_pseudo_day(slicing.add_hour(df)).collect()}
    turned = {r.V2: r.Date for r in slicing.assign_pseudo_day(df.select("V2", "V1", "Time", "Amount")).collect()}
    assert plain == with_hour == turned
    assert {r.V2 for r in slicing.extract_day(df, 15).collect()} == {v for v, d in with_hour.items() if d == 15}


def test_one_slice_shuffles_no_feature_column(spark):
    df = make(spark, random_rows(500)).withColumn("V9", F.col("V1") * 2)
    plan = slicing.extract_day(df, 7)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan and "BroadcastHashJoin" in plan


@pytest.mark.parametrize("keys", [slicing.BROADCAST_KEYS, 0])
def test_single_slices_equal_those_of_the_whole_table(spark, monkeypatch, keys):
    """With ties, with copies of one row that are dealt to all slices, and with either join."""
    monkeypatch.setattr(slicing, "BROADCAST_KEYS", keys)
    monkeypatch.setattr(slicing, "COPIES_PER_CHUNK", 40)
    df = make(spark, random_rows(300) + [(5.0, 1.0, 1.0, 0)] * 4000 + [(7.0, 2.0, 2.0, 1)] * 30)
    whole = slicing.assign_pseudo_day(df).checkpoint()
    index = slicing.order_index(df).checkpoint()
    for day in (1, 20, 50):
        want = whole.filter(F.col("Date") == day)
        for got in (slicing.extract_day(df, day), slicing.extract_day(df, day, index)):
            assert got.columns == want.columns
            assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
