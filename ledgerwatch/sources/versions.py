"""A folder of versions, of which the last committed one counts.

A version is written in a folder of its own. It is committed by one empty file whose name holds its number and its folder, so
a job that ends at any point leaves the version before it, and a reader sees one version or the other, never a part.
One writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

KEPT_VERSIONS = 2


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what a folder holds; none if there is no folder."""
    files, where = _files(spark, folder)
    return sorted(s.getPath().getName() for s in files.listStatus(where)) if files.exists(where) else []


def remove(spark: SparkSession, folder: str) -> None:
    files, where = _files(spark, folder)
    files.delete(where, True)


def _commits(spark: SparkSession, root: str) -> list[str]:
    return [n for n in names(spark, f"{root}/committed") if not n.startswith((".", "_"))]


def current(spark: SparkSession, root: str) -> str:
    """The folder of the last committed version."""
    commits = _commits(spark, root)
    if not commits:
        raise FileNotFoundError(f"no version is committed in {root}")
    return f"{root}/versions/{commits[-1].split('.')[1]}"


def put(spark: SparkSession, root: str, write: Callable[[str], None], keep: int = KEPT_VERSIONS) -> str:
    """Let `write` fill the folder of a new version, commit it, and return it. All but the last `keep` versions are removed."""
    commits = _commits(spark, root)
    number = int(commits[-1].split(".")[0]) + 1 if commits else 1
    version = uuid.uuid4().hex
    folder = f"{root}/versions/{version}"
    write(folder)
    files, mark = _files(spark, f"{root}/committed/{number:012d}.{version}")
    if not files.createNewFile(mark):
        raise FileExistsError(f"another writer committed version {number} of {root}")
    _clean(spark, root, keep)
    return folder


def _clean(spark: SparkSession, root: str, keep: int) -> None:
    """Remove what no reader should still use: old versions, and folders that a failed writer left."""
    commits = _commits(spark, root)
    known = {c.split(".")[1] for c in commits[-keep:]}
    for commit in commits[:-keep]:
        remove(spark, f"{root}/committed/{commit}")
    for version in names(spark, f"{root}/versions"):
        if version not in known:
            remove(spark, f"{root}/versions/{version}")
