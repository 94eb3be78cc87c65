"""Partitions that are whole or untouched.

New partitions are written in full beside the tables, under `<root>/_staged/<table>/<time>`. A marker file then commits
them all; what follows only moves folders, and whoever writes to the table next finishes the moves of a driver that
was lost in between. Without the marker the new ones never counted and are removed. Readers find each partition old or
new; one that is being moved is absent for a moment, as a file system has no exchange of two folders. One writer a table.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from eodlake.session import delete, exists, file_system, folders, make_folder

_MARKER = "COMMITTED"


def leaves(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Partition folders below `path`, as `a=1/b=2`."""
    found = [f for f in folders(spark, path) if "=" in f]
    if depth == 1:
        return found
    return [f"{f}/{rest}" for f in found for rest in leaves(spark, f"{path}/{f}", depth - 1)]


def _move(spark: SparkSession, source: str, target: str) -> None:
    fs, place = file_system(spark, target)
    fs.mkdirs(place.getParent())
    if not fs.rename(file_system(spark, source)[1], place):
        raise OSError(f"could not move {source}")


class Stage:
    """New partitions of one table until they are committed; as a context it removes them if they were not."""

    def __init__(self, spark: SparkSession, root: str, table: str, partition: tuple[str, ...]):
        self.spark, self.target, self.partition = spark, f"{root}/{table}", partition
        self.path = f"{root}/_staged/{table}/{time.time_ns():020d}-{uuid.uuid4().hex}"

    @property
    def new(self) -> str:
        return f"{self.path}/new"

    def write(self, df: DataFrame, key: tuple[str, ...], folder: str = "new") -> list[str]:
        """Write rows by partition, each sorted by key; the partitions written. File sizes are left to adaptive execution."""
        ordered = [*self.partition, *[c for c in key if c not in self.partition]]
        path = f"{self.path}/{folder}"
        df.hint("rebalance", *self.partition).sortWithinPartitions(*ordered).write.partitionBy(*self.partition).parquet(path)
        return leaves(self.spark, path, len(self.partition))

    def replace(self, folder: str) -> None:
        """Take the partitions of another folder of the stage instead of the same ones in `new`."""
        for leaf in leaves(self.spark, f"{self.path}/{folder}", len(self.partition)):
            delete(self.spark, f"{self.new}/{leaf}")
            _move(self.spark, f"{self.path}/{folder}/{leaf}", f"{self.new}/{leaf}")

    def empty(self, leaf: str) -> None:
        """A partition that ends up without rows."""
        make_folder(self.spark, f"{self.new}/{leaf}")

    def commit(self) -> None:
        fs, marker = file_system(self.spark, f"{self.path}/{_MARKER}")
        fs.create(marker).close()
        self.finish()

    def finish(self) -> None:
        """Move what is committed and not yet moved. The partition before waits in the stage until all is done."""
        for leaf in sorted(leaves(self.spark, self.new, len(self.partition))):
            if exists(self.spark, f"{self.target}/{leaf}"):
                _move(self.spark, f"{self.target}/{leaf}", f"{self.path}/old/{leaf}")
            _move(self.spark, f"{self.new}/{leaf}", f"{self.target}/{leaf}")
        delete(self.spark, self.path)

    def __enter__(self) -> Stage:
        return self

    def __exit__(self, *exc) -> None:
        if not exists(self.spark, f"{self.path}/{_MARKER}"):
            delete(self.spark, self.path)


def recover(spark: SparkSession, root: str, table: str, partition: tuple[str, ...]) -> None:
    """Finish the commits of a table that were cut off, in their order, and remove what was never committed."""
    for name in sorted(folders(spark, f"{root}/_staged/{table}")):
        stage = Stage(spark, root, table, partition)
        stage.path = f"{root}/_staged/{table}/{name}"
        if exists(spark, f"{stage.path}/{_MARKER}"):
            stage.finish()
        else:
            delete(spark, stage.path)
