import uuid
from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerwatch.functions.columns import stamp
from ledgerwatch.operators import history, scores
from ledgerwatch.plans.names import WITH_HISTORY, Tables
from ledgerwatch.sources import tables as sources
from ledgerwatch.sources import versions


@pytest.fixture
def tables(spark):
    schema = f"t_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE SCHEMA {schema}")
    return Tables(schema)


def test_table_names():
    assert sources.check_table_name("a.b.c") == "a.b.c"
    for bad in ("a.b.c; DROP TABLE x", "only.two", "a.b.c\n", "a.b.c.d"):
        with pytest.raises(ValueError):
            sources.check_table_name(bad)


def test_load_replaces_and_counts(spark, tables):
    assert sources.overwrite_slice(spark.range(10), tables["x"]) == 10
    assert sources.overwrite_slice(spark.range(4), tables["x"]) == 4
    assert spark.table(tables["x"]).count() == 4


def test_empty_load_leaves_the_table(spark, tables):
    sources.overwrite_slice(spark.range(3), tables["x"])
    with pytest.raises(sources.EmptyInput):
        sources.overwrite_slice(spark.range(0), tables["x"])
    assert spark.table(tables["x"]).count() == 3


@pytest.mark.parametrize("by", [(), ("part",)])
@pytest.mark.parametrize("load", [sources.overwrite_slice, sources.replace_table])
def test_a_failed_load_leaves_the_table(spark, tables, load, by):
    good = spark.range(10).withColumn("part", F.col("id") % 2)
    load(good, tables["x"], partition_by=by)
    stop = F.when(F.col("id") == 7, F.raise_error(F.lit("stop")).cast("long")).otherwise(F.col("id"))
    with pytest.raises(Exception, match="stop"):
        load(spark.range(5, 10).withColumn("part", F.col("id") % 2).withColumn("id", stop), tables["x"], partition_by=by)
    assert spark.table(tables["x"]).count() == 10
    load(good.limit(4), tables["x"], partition_by=by)
    assert spark.table(tables["x"]).count() == 4
    names = [t.name for t in spark.catalog.listTables(tables["x"].split(".")[1])]
    assert [n for n in names if sources.VERSION not in n] == ["x"] and len(names) == 3


class Killed(BaseException):
    """Ends a job without its clean-up, as a kill does."""


@pytest.mark.parametrize("by", [(), ("part",)])
@pytest.mark.parametrize("step", ["before", "write", "point", "clean"])
def test_a_killed_load_leaves_a_readable_table(spark, tables, monkeypatch, by, step):
    old, new = (spark.range(n).withColumn("part", F.col("id") % 2) for n in (10, 4))
    sources.replace_table(old, tables["x"], partition_by=by)

    def stop(*_, **__):
        raise Killed

    with monkeypatch.context() as m:
        if step == "before":
            m.setattr(type(old.write), "saveAsTable", stop)
        elif step == "write":
            save = type(old.write).saveAsTable
            m.setattr(type(old.write), "saveAsTable", lambda self, *a, **b: (save(self, *a, **b), stop()))
        else:
            m.setattr(sources, f"_{step}", stop)
        with pytest.raises(Killed):
            sources.replace_table(new, tables["x"], partition_by=by)
    assert spark.table(tables["x"]).count() == (4 if step == "clean" else 10)
    sources.replace_table(new.limit(3), tables["x"], partition_by=by)
    assert spark.table(tables["x"]).count() == 3
    schema = tables["x"].split(".")[1]
    assert len(spark.catalog.listTables(schema)) == 3
    home = spark.catalog.getDatabase(schema).locationUri
    assert len(versions.names(spark, home)) == 2


def test_folders_of_unfinished_writes_are_removed(spark, tables):
    sources.replace_table(spark.range(3), tables["x"])
    home = spark.catalog.getDatabase(tables["x"].split(".")[1]).locationUri
    spark.range(5).write.parquet(f"{home}/x{sources.VERSION}00_left")
    sources.replace_table(spark.range(2), tables["x"])
    assert not [n for n in versions.names(spark, home) if n.endswith("_left")]


def test_a_reader_keeps_the_version_it_began_with(spark, tables):
    sources.replace_table(spark.range(7), tables["x"])
    reader = spark.table(tables["x"])
    sources.replace_table(spark.range(2).withColumn("more", F.lit(1)), tables["x"])
    assert reader.count() == 7 and spark.table(tables["x"]).columns == ["id", "more"]


def test_a_plain_table_is_taken_over(spark, tables):
    spark.range(6).write.saveAsTable(tables["x"])
    assert sources.overwrite_slice(spark.range(2), tables["x"]) == 2
    assert spark.table(tables["x"]).count() == 2 and sources.version_of(spark, tables["x"])


def test_pruning_reaches_the_version(spark, tables):
    sources.replace_table(spark.range(10).withColumn("part", F.col("id") % 5), tables["x"], partition_by=("part",))
    plan = spark.table(tables["x"]).filter("part = 3")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(part" in plan and plan.count("Exchange") == 0


def test_copy_source(spark, tables):
    rows = spark.createDataFrame([(1.0, 5.0), (None, 6.0)], "Time double, Amount double")
    sources.replace_table(rows, tables["outside"])
    assert sources.copy_source(spark, tables["outside"], tables["public"]) == 1
    sources.replace_table(rows.filter("Time IS NULL"), tables["outside"])
    with pytest.raises(sources.EmptyInput):
        sources.copy_source(spark, tables["outside"], tables["public"])
    assert spark.table(tables["public"]).count() == 1


def test_files_are_read_with_the_declared_schema(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 2.0, 9.5, 1)], "Time double, V1 double, Amount double, Class int")
    df.write.parquet(str(tmp_path / "in"))
    got = sources.read_transactions(spark, str(tmp_path / "in"))
    assert len(got.columns) == 31 and got.first().Amount == 9.5 and got.first().V2 is None


def run(spark, value, run_ts):
    return stamp(spark.createDataFrame([(value,)], "psi double"), run_ts)


def test_snapshot_keeps_the_first_copy_of_a_date(spark, tables):
    source, past = tables["psi"], tables.history("psi")
    history.snapshot_history(spark, source, past)
    assert not spark.catalog.tableExists(past)
    for value, run_ts in ((1.0, "2024-01-15T03:00:00"), (2.0, "2024-01-15T09:00:00"), (3.0, "2024-01-16T03:00:00")):
        history.snapshot_history(spark, source, past)
        sources.replace_table(run(spark, value, run_ts), source)
    history.snapshot_history(spark, source, past)
    history.snapshot_history(spark, source, past)
    rows = spark.table(past).orderBy("evaluation_date").collect()
    assert [(r.evaluation_date, r.psi) for r in rows] == [(date(2024, 1, 15), 1.0), (date(2024, 1, 16), 3.0)]
    assert set(spark.table(past).columns) == set(spark.table(source).columns)


@pytest.mark.parametrize("step", ["half", "after", "note"])
def test_a_killed_snapshot_can_be_repeated(spark, tables, monkeypatch, step):
    source, past = tables["psi"], tables.history("psi")
    sources.replace_table(run(spark, 1.0, "2024-01-15T03:00:00"), source)
    history.snapshot_history(spark, source, past)
    whole = run(spark, 2.0, "2024-01-16T03:00:00").unionByName(run(spark, 3.0, "2024-01-16T03:00:00"))
    sources.replace_table(whole, source)
    if step == "half":  # a part of the date is there, the rest is not
        spark.table(source).limit(1).select(*spark.table(past + history.ROWS).columns).write.insertInto(past + history.ROWS)
    else:
        real = history._replace_date

        def stop(*a, **b):
            if step == "after":
                real(*a, **b)
            raise Killed

        where, name = (history, "_replace_date") if step == "after" else (type(whole.write), "saveAsTable")
        with monkeypatch.context() as m:
            m.setattr(where, name, stop)
            with pytest.raises(Killed):
                history.snapshot_history(spark, source, past)
    assert [r.psi for r in spark.table(past).collect()] == [1.0]
    history.snapshot_history(spark, source, past)
    assert sorted(r.psi for r in spark.table(past).collect()) == [1.0, 2.0, 3.0]
    sources.replace_table(run(spark, 9.0, "2024-01-16T09:00:00"), source)
    history.snapshot_history(spark, source, past)
    assert sorted(r.psi for r in spark.table(past).collect()) == [1.0, 2.0, 3.0]


def test_a_plain_history_is_taken_over(spark, tables):
    past = tables.history("psi")
    run(spark, 1.0, "2024-01-15T03:00:00").write.partitionBy("evaluation_date").saveAsTable(past)
    sources.replace_table(run(spark, 5.0, "2024-01-15T03:00:00").unionByName(run(spark, 2.0, "2024-01-16T03:00:00")), tables["psi"])
    history.snapshot_history(spark, tables["psi"], past)
    assert sorted(r.psi for r in spark.table(past).collect()) == [1.0, 2.0]


def test_series_prefers_the_current_table(spark):
    past = run(spark, 1.0, "2024-01-15T03:00:00").unionByName(run(spark, 2.0, "2024-01-16T03:00:00"))
    rows = history.series(past, run(spark, 9.0, "2024-01-16T05:00:00")).orderBy("evaluation_date").collect()
    assert [r.psi for r in rows] == [1.0, 9.0]


def test_stamp_uses_the_business_date(spark):
    row = run(spark, 1.0, "2024-01-15T16:00:00").select("evaluation_date", F.col("evaluated_at").cast("long").alias("s")).first()
    assert row.evaluation_date == date(2024, 1, 16) and row.s == 1705334400


def test_retrain_trigger(spark):
    psi = spark.createDataFrame([(date(2024, 1, 1), 0.3), (date(2024, 1, 2), 0.1)], "evaluation_date date, psi double")
    rows = [(date(2024, 1, 1), 0.9, 1), (date(2024, 1, 1), 0.8, 0), (date(2024, 1, 2), 0.85, 0), (date(2024, 1, 2), 0.7, 1), (date(2024, 2, 1), 0.5, 1)]
    scored = spark.createDataFrame([(*r, 5.0) for r in rows], "evaluation_date date, fraud_probability double, Class int, Amount double")
    ladders = scores.score_ladder(scored, by=["evaluation_date"])
    got = {(r.signal, r.period): (r.metric_value, r.retrain) for r in history.retrain_trigger(psi, ladders).collect()}
    assert got == {
        ("psi_daily", date(2024, 1, 1)): (0.3, True),
        ("psi_daily", date(2024, 1, 2)): (0.1, False),
        ("pr_auc_monthly", date(2024, 1, 1)): (pytest.approx((1 + 2 / 4) / 2), True),  # pooled: 1 of 1, then 2 of 4
        ("pr_auc_monthly", date(2024, 2, 1)): (1.0, False),
    }


def test_nine_tables_keep_a_history():
    assert len(WITH_HISTORY) == 9 and Tables("s").history("psi") == "spark_catalog.s.v_detection_psi"


def test_a_partitioned_table_has_few_files(spark, tables):
    """Not one from every task for every value: each file is opened by every reading."""
    rows = spark.range(0, 4000, 1, 40).withColumn("part", F.when(F.col("id") % 11 > 0, F.col("id") % 11))
    sources.replace_table(rows, tables["x"], partition_by=("part",))
    assert len(spark.table(tables["x"]).inputFiles()) <= 2 * 11
    assert spark.table(tables["x"]).exceptAll(rows).isEmpty() and spark.table(tables["x"]).count() == 4000


def test_cleaning_looks_at_the_versions_of_one_table(spark, tables, monkeypatch):
    """The tables beside it, each looked up by itself, took most of a small load's time."""
    sources.replace_table(spark.range(1), tables["xy"])
    monkeypatch.setattr(type(spark.catalog), "listTables", None)
    for n in (3, 2, 1):
        sources.replace_table(spark.range(n), tables["x"])
    shown = [r.tableName for r in spark.sql(f"SHOW TABLES IN {tables['x'].rsplit('.', 1)[0]}").collect()]
    assert sorted(n.split(sources.VERSION)[0] for n in shown) == ["x", "x", "x", "xy", "xy"]
