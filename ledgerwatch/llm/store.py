"""Intermediate tables in the session's shared folder, and column helpers that several operators use."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwatch.session import use_checkpoint_dir

# Fixed value: a word is a run of characters other than space, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]+"


_tables: dict[str, str] = {}


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as Parquet into the shared folder and read it back: lineage ends there, and it survives lost executors.

    The table is removed by `forget`, by the next stage of a pipeline (`forget_before`), or when the session ends.
    """
    spark = df.sparkSession
    path = f"{use_checkpoint_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    files, where = _files(spark, path)
    files.deleteOnExit(where)
    _tables[path] = spark.sparkContext.applicationId
    out = spark.read.schema(df.schema).parquet(path)
    out._work_table = path
    return out


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _remove(spark: SparkSession, path: str) -> None:
    files, where = _files(spark, path)
    files.delete(where, True)
    _tables.pop(path, None)


def forget(*tables: DataFrame) -> None:
    """Remove work tables that nothing reads any more."""
    for table in tables:
        _remove(table.sparkSession, table._work_table)


def forget_before(docs: DataFrame) -> None:
    """Remove the work tables that earlier operators of this session left, where `docs` is a stored table and reads none of them.

    For stages that run one after the other, each on the written result of the one before.
    """
    spark = docs.sparkSession
    old = [path for path, session in _tables.items() if session == spark.sparkContext.applicationId]
    read = docs.inputFiles()
    if read and not any("/llm/" in f and p.rsplit("/", 1)[1] in f for f in read for p in old):
        for path in old:
            _remove(spark, path)


def text_of(docs: DataFrame, text: str = "text") -> Column:
    """The text column as a string; null counts as empty."""
    return F.coalesce(docs[text].cast("string"), F.lit(""))


def bound(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value) with the value computed once per row, also where `then` uses it inside a lambda."""
    return F.get(F.transform(F.array(value), then), 0)


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def null_last(column: Column) -> Column:
    """A join and sort key for a nullable string: null has a key of its own that sorts last."""
    return F.coalesce(F.concat(F.lit("+"), column.cast("string")), F.lit("-"))


def stable_key(docs: DataFrame, id_col: str, text: str) -> Column:
    """Text to hash for a position that reruns repeat: the id, or the text where there is no id."""
    return F.coalesce(docs[id_col].cast("string"), docs[text].cast("string"), F.lit(""))


def crc_fold(id_col: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; a missing id counts as empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % F.lit(folds)
