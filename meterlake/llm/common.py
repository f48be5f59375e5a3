"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import atexit
import importlib.util
import os
import shutil
import sys
import tempfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 1_000_000
SPACES = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder, whatever file system it is on."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let the executors' Python import this package.

    Where it was found by the environment, executors that share it find it as well.
    Where the driver's own search path led to it, it is sent along once per application,
    as `--py-files` would.
    """
    package = __name__.partition(".")[0]
    root = Path(importlib.util.find_spec(package).origin).parent.parent
    shared = [*os.environ.get("PYTHONPATH", "").split(os.pathsep), sys.prefix, os.getcwd()]
    found = any(p and root.is_relative_to(Path(p).resolve()) for p in shared)
    app = spark.sparkContext.applicationId
    if found or app in _shipped:
        return
    # the driver serves the file for as long as it runs
    folder = tempfile.mkdtemp(prefix=f"{package}-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = shutil.make_archive(f"{folder}/{package}", "zip", root, package)
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)


def held_out(doc_id: str) -> Column:
    """Whether crc32 of the id as text leaves 2 modulo 4; a null id is not held out."""
    rest = F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4
    return F.coalesce(rest == 2, F.lit(False))


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that `df` does not have."""
    taken = {c.lower() for c in df.columns}
    name = f"_{stem}"
    while name in taken:
        name = f"_{name}"
    return name


def numbered(df: DataFrame, name: str) -> DataFrame:
    """`df`, a stored table, with a number that tells equal rows apart.

    It follows from the scan's splits alone, so a retry and a second scan of the same
    files give each row the same number.
    """
    return df.withColumn(name, F.monotonically_increasing_id())


def joined_by_row(
    facts: DataFrame, picked: DataFrame, key: str | list[str], how: str = "inner"
) -> DataFrame:
    """`facts` joined to `picked`, a stored table with few narrow columns, unique in `key`.

    `picked` is broadcast up to a counted number of rows, which bounds its size, and
    joined by shuffle beyond that.
    """
    if picked.count() <= BROADCAST_ROWS:
        picked = F.broadcast(picked)
    return facts.join(picked, key, how)
