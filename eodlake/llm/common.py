"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import gc
import string
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eodlake.session import checkpoint_root, shuffles_removed

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Words are runs of anything but the six ASCII blanks, the same as bytes.split() of the UTF-8 text.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """The rows of `df`, written to the shared checkpoint folder so that nothing is computed twice."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(checkpoint_root(df.sparkSession))
    with shuffles_removed(df.sparkSession):
        return df.checkpoint()


def release(spark: SparkSession) -> None:
    """Let go of the shuffle files of steps whose rows are cut: Spark removes them when the driver has collected what named them."""
    gc.collect()
    for _ in range(2):  # what named them is itself held by objects that go in a first round
        spark._jvm.System.gc()
        time.sleep(0.2)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that `df` doesn't have yet, in any spelling."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_keys(df: DataFrame, id_col: str, text_col: str, name: str) -> DataFrame:
    """`df` with a number `name`, the same for rows alike in id and text and for no others, in the order of the ids, nulls last.

    Where ids are there and differ, as they should, they are the numbers. Else the distinct (id, hash of the text) are sorted
    over all tasks and numbered along.
    """
    id_ = F.col(id_col).cast("long")
    odd = df.groupBy(id_.alias("id")).agg(F.count("*").alias("n")).where("id IS NULL OR n > 1")
    if odd.isEmpty():
        return df.withColumn(name, id_)
    mark = fresh(df, "text_mark")
    marked = df.withColumn(mark, F.xxhash64(text_col))
    keys = marked.select(id_.alias("key_id"), F.col(mark).alias("key_mark")).distinct()
    keys = cut(keys.orderBy(F.asc_nulls_last("key_id"), "key_mark").withColumn(name, F.monotonically_increasing_id()))
    same = id_.eqNullSafe(F.col("key_id")) & (F.col(mark) == F.col("key_mark"))
    return marked.join(keys, same).select(*df.columns, name)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def utf8(name: str) -> Column:
    """A text column as bytes; null becomes empty."""
    return F.coalesce(F.col(name).cast("binary"), F.lit(b""))
