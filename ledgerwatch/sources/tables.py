"""Loading tables: whole copies and slice loads that replace their target."""

from __future__ import annotations

import re
import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from ledgerwatch import config
from ledgerwatch.sources import versions

# Fixed value: accepted form of a target name, catalog.schema.table.
TABLE_NAME = re.compile(r"^[a-zA-Z0-9_-]+\.[a-zA-Z0-9_]+\.[a-zA-Z0-9_]+$")

TRANSACTIONS = StructType(
    [
        StructField("Time", DoubleType()),
        *[StructField(f, DoubleType()) for f in config.PCA_FEATURES],
        StructField("Amount", DoubleType()),
        StructField("Class", IntegerType()),
    ]
)


class EmptyInput(RuntimeError):
    """A load had no rows; the target was left as it is."""


def check_table_name(name: str) -> str:
    if not TABLE_NAME.fullmatch(name):
        raise ValueError(f"table must be catalog.schema.table, got {name!r}")
    return name


def read_transactions(spark: SparkSession, source: str) -> DataFrame:
    """A stored table by name, or Parquet files by path, with the declared transaction schema."""
    if "/" in source:
        return spark.read.schema(TRANSACTIONS).parquet(source)
    return spark.table(source)


# --- versions of a table ---------------------------------------------------------------------------------------
#
# The name of a table is a view of its current version, which is a table of its own. A load writes a new version beside it
# and points the view there: one change of the catalog. A job that ends at any point leaves a readable table, the old one
# or the new one; what it left behind goes with the next load. One writer at a time for each table.

VERSION = "__v_"


def quoted(table: str) -> str:
    return ".".join(f"`{part}`" for part in table.split("."))


def version_of(spark: SparkSession, table: str) -> str | None:
    """The table that the view `table` shows; None if there is no such view."""
    if not spark.catalog.tableExists(table):
        return None
    found = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {quoted(table)}").collect()}
    return found.get("ledgerwatch.version")


def _point(spark: SparkSession, table: str, version: str) -> None:
    """Show `version` under the name `table`. A plain table of that name becomes a version first."""
    if spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType != "VIEW":
        spark.sql(f"ALTER TABLE {quoted(table)} RENAME TO {quoted((table + VERSION + '0').split('.', 1)[1])}")
    spark.sql(
        f"CREATE OR REPLACE VIEW {quoted(table)} TBLPROPERTIES ('ledgerwatch.version' = '{version}') AS SELECT * FROM {quoted(version)}"
    )


def _clean(spark: SparkSession, table: str) -> None:
    """Drop all versions but the current one and the one before it, which readers may still use, and folders of loads that
    ended while they wrote."""
    catalog, schema, name = table.split(".")
    current = (version_of(spark, table) or "").split(".")[-1]
    listed = spark.sql(f"SHOW TABLES IN {quoted(f'{catalog}.{schema}')} LIKE '{name.lower()}{VERSION}*'").collect()
    known = sorted(t.tableName for t in listed if not t.isTemporary)
    before = [v for v in known if v < current][-1:]
    for version in known:
        if version not in (current, *before):
            spark.sql(f"DROP TABLE IF EXISTS {quoted(f'{catalog}.{schema}.{version}')}")
    home = spark.catalog.getDatabase(f"{catalog}.{schema}").locationUri
    for folder in versions.names(spark, home):
        if folder.startswith(name.lower() + VERSION) and folder not in known:
            versions.remove(spark, f"{home}/{folder}")


def _switch_to(df: DataFrame, table: str, partition_by: tuple[str, ...]) -> None:
    """Write a new version of `table` and show it. A load that fails leaves `table` as it was, and no other table.

    Rows are brought together by the values of `partition_by` first, and Spark splits what is large: a value has a few files, not
    one from every task.
    """
    spark = df.sparkSession
    if partition_by:
        df = df.hint("rebalance", *[F.col(f"`{c}`") for c in partition_by])
    version = f"{table}{VERSION}{time.time_ns():020d}_{uuid.uuid4().hex[:8]}".lower()
    try:
        writer = df.write.mode("errorifexists")
        (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(version)
        _point(spark, table, version)
    except Exception:
        if version_of(spark, table) != version:
            spark.sql(f"DROP TABLE IF EXISTS {quoted(version)}")
        raise
    _clean(spark, table)


def overwrite_slice(df: DataFrame, table: str, partition_by: tuple[str, ...] = ()) -> int:
    """Replace the whole table by `df` and return the row count; refuse an empty input.

    The emptiness test stops at the first row. Give it a stored table or a filter on one, not an unfinished sort:
    what is expensive to compute should be stored before it is loaded. The count is taken while writing.
    """
    check_table_name(table)
    if df.isEmpty():
        raise EmptyInput(f"no rows for {table}; the table is left unchanged")
    loaded = Observation()
    _switch_to(df.observe(loaded, F.count(F.lit(1)).alias("n")), table, partition_by)
    return int(loaded.get["n"])


def replace_table(df: DataFrame, table: str, partition_by: tuple[str, ...] = ()) -> None:
    """Create or replace a derived table; an empty result is a valid one."""
    check_table_name(table)
    _switch_to(df, table, partition_by)


def known_time(df: DataFrame) -> DataFrame:
    return df.filter(F.col("Time").isNotNull())


def copy_source(spark: SparkSession, source: str, target: str) -> int:
    """Copy every row that has a time; returns the number of rows."""
    return overwrite_slice(known_time(read_transactions(spark, source)), target)
