"""Shared scratch space and file-system access through the session's own settings."""

from __future__ import annotations

import itertools
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOTS: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir.

    Only a local session may go without: it gets one temporary folder of its own. On a cluster a
    machine-local folder would be lost with its machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="eodlake-")
    return _LOCAL_ROOTS[app]


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, path object) of a location."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = file_system(spark, path)
    return fs.exists(target)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder."""
    fs, target = file_system(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(target) if f.isDirectory()] if fs.exists(target) else []


def make_folder(spark: SparkSession, path: str) -> None:
    fs, target = file_system(spark, path)
    fs.mkdirs(target)


def delete(spark: SparkSession, path: str) -> None:
    fs, target = file_system(spark, path)
    fs.delete(target, True)


def replace_folder(spark: SparkSession, new: str, target: str) -> None:
    """Put the complete folder `new` in the place of `target`; the old one stays until the new one is there."""
    fs, place = file_system(spark, target)
    old = file_system(spark, f"{target}.old")[1]
    fs.delete(old, True)
    if fs.exists(place) and not fs.rename(place, old):
        raise OSError(f"could not move {target}")
    if not fs.rename(file_system(spark, new)[1], place):
        fs.rename(old, place)
        raise OSError(f"could not move {new}")
    fs.delete(old, True)


def recover_folder(spark: SparkSession, target: str) -> None:
    """Bring back the old folder of a `replace_folder` that was cut off between its two moves."""
    fs, place = file_system(spark, target)
    old = file_system(spark, f"{target}.old")[1]
    if not fs.exists(place) and fs.exists(old):
        fs.rename(old, place)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within the block, Spark removes the shuffle files of every query as it ends; for tables that are written once."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


class Scratch:
    """A fresh folder for intermediate tables, removed on leaving the `with` block.

    Written tables cut the lineage: later jobs read columns from Parquet and a lost executor costs
    a re-read, not a re-parse of the input. What is written `instead` of an earlier table removes it. With `lean`, the shuffle files of a write go with its end; not for
    loads that run side by side, as this is a setting of the session.
    """

    def __init__(self, spark: SparkSession, lean: bool = False):
        self.spark, self.lean = spark, lean
        self.path = f"{checkpoint_root(spark)}/eodlake/{uuid.uuid4().hex}"
        self._numbers = itertools.count(1)  # loads that run side by side share a scratch folder

    def write(self, df: DataFrame, instead: DataFrame | None = None) -> DataFrame:
        path = f"{self.path}/{next(self._numbers)}"
        with shuffles_removed(self.spark) if self.lean else nullcontext():
            df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        if instead is not None:
            delete(self.spark, instead._scratch_path)
        return out

    def folder(self) -> str:
        """The address of a folder inside, for files that are no table."""
        return f"{self.path}/files-{next(self._numbers)}"

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *exc) -> None:
        delete(self.spark, self.path)
