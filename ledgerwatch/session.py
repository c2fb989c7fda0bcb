"""Session settings the jobs rely on, and steps of a job that run side by side."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

SIDE_BY_SIDE = 8


def at_once(spark: SparkSession, *steps: Callable[[], object]) -> list:
    """Run steps that do not need one another side by side: each is a chain of small Spark jobs that leaves most cores idle.

    Returns what they return. All steps are run to their end; then the first failure, in the order of the steps, is raised.
    """
    with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
        begun = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [step.result() for step in begun]


def use_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and work tables: `spark.checkpoint.dir`, read from the session.

    Where the session has none (tests, single machines) it lies in the warehouse, which every executor sees as well.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder
