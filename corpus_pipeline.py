"""The corpus pipeline: documents through quality rules, near-dedup, decontamination, mixing and sharding."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerwatch.llm import decontamination, mixing, near_dup, quality_rules, sharding
from ledgerwatch.llm.store import forget_before
from ledgerwatch.session import use_checkpoint_dir

SHARD_BYTES = 1 << 20
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.kept_rows(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity 0.8 or more."""
    return near_dup.deduplicated(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.clean_rows(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents by source targets; a document is repeated as often as its source needs epochs."""
    return mixing.mixed_rows(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the shard they belong to; the names of the new columns get a prefix where `docs` has such columns."""
    added, prefix = ("shard", "shard_depth", "shard_bytes", "row_bytes"), ""
    while any(prefix + name in docs.columns for name in added):
        prefix += "new_"
    return sharding.shard(docs, SHARD_BYTES, prefix_name=prefix)


def _tidy(stage: Stage) -> Stage:
    """The stage, after the work tables of the stages before it are removed: its input is their written result."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        forget_before(docs)
        return stage(spark, docs, sf_dir)

    return run_stage


# Every stage keeps all columns of its input. Null, empty and very long texts, null ids, ties and repeated rows are handled as the
# docstring of each operator says: without words a document fails the quality rules, so none reaches the other stages; equal
# texts are one document after near-dedup. Empty input: empty result.
STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", _tidy(quality)),
    ("minhash_near_dedup", _tidy(near_dedup)),
    ("benchmark_decontamination", _tidy(decontaminate)),
    ("source_mixing", _tidy(mix)),
    ("sharding", _tidy(shard)),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each is written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{use_checkpoint_dir(spark)}/pipeline/{uuid.uuid4().hex}"
    for place, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if place == len(STAGES) - 1:
            return out
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.schema(out.schema).parquet(f"{folder}/{name}")
    return docs


# Near-dedup and decontamination have no SQL form; tests/llm compares the whole pipeline with a brute-force version.
ORACLE_SQL = None
