"""Landing folders and archives made from the bridge views, written by Spark tasks."""

from __future__ import annotations

import csv
import io
import uuid
import zipfile
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eodlake.functions.text import col
from eodlake.operators.commit import leaves
from eodlake.session import checkpoint_root, delete, file_system
from eodlake.sources.files import day_file_name
from eodlake.sources.streams import located

_PLACE = ("year", "mon", "name")


def fresh_folder(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark)}/eodlake-queries/{uuid.uuid4().hex}"


def _placed(raw: DataFrame, product: str, ordered: bool, *columns: Column) -> DataFrame:
    """(year, mon, name, *columns) by range of (day, `row_no`), in order; rows that are `ordered` by range already stay where they are."""
    day = F.col("file_date")
    place = [F.date_format(day, "yyyy").alias("year"), F.upper(F.date_format(day, "MMM")).alias("mon"), day_file_name(product, day).alias("name")]
    placed = raw.select(*place, "row_no", *columns)
    by = [*_PLACE, "row_no"]
    return (placed if ordered else placed.repartitionByRange(*by)).sortWithinPartitions(*by).drop("row_no")


def _settle(spark: SparkSession, draft: str, root: str, product: str) -> None:
    """Move the days written to a draft to their places, where they replace what is there; no rows are read for it."""
    for leaf in leaves(spark, draft, len(_PLACE)):
        year, month, name = (part.partition("=")[2] for part in leaf.split("/"))
        if not year.isdigit():
            raise ValueError("rows without a day have no file")
        target = f"{root}/{product}/{year}/{month}"
        fs, folder = file_system(spark, target)
        fs.mkdirs(folder)
        delete(spark, f"{target}/{name}")
        if not fs.rename(file_system(spark, f"{draft}/{leaf}")[1], file_system(spark, f"{target}/{name}")[1]):
            raise OSError(f"could not move {leaf}")
    delete(spark, draft)


def write_landing(raw: DataFrame, product: str, root: str, ordered: bool = False) -> None:
    """Write a raw frame as one folder of CSV parts per day, in the landing layout.

    Rows are spread by range of (day, `row_no`), so part names follow the file order, and a day has as many parts as its
    rows need, not one for every task. `ordered` tells that they are spread so.
    """
    draft = f"{root}/draft-{uuid.uuid4().hex}"
    headers = [col(c) for c in raw.columns if c not in ("file_date", "row_no")]
    _placed(raw, product, ordered, *headers).write.partitionBy(*_PLACE).options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(draft)
    _settle(raw.sparkSession, draft, root, product)


def write_archives(raw: DataFrame, product: str, root: str, ordered: bool = False) -> None:
    """Write a raw frame as one folder of zip archives per day, in the landing layout.

    Rows are spread as by `write_landing`. Each Arrow batch is packed by itself, one archive per day in it, so no
    task holds more than a batch; a batch holds few days, so archives are as many as full batches, about. Names follow the
    file order.
    """
    draft = f"{root}/draft-{uuid.uuid4().hex}"
    headers = [c for c in raw.columns if c not in ("file_date", "row_no")]
    options = {"escape": '"', "emptyValue": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    line = F.to_csv(F.struct(*[col(h) for h in headers]), options).alias("line")
    folder = F.concat(F.lit(draft), *[x for c in _PLACE for x in (F.lit(f"/{c}="), F.col(c))]).alias("folder")
    first = io.StringIO()
    csv.writer(first, lineterminator="").writerow(headers)
    top = first.getvalue()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for k, batch in enumerate(batches):
            packed, start = [], 0
            for run in pc.run_end_encode(batch.column(0)).run_ends.to_pylist() if batch.num_rows else ():
                path, rows = batch.column(0)[start].as_py(), batch.column(1).slice(start, run - start)
                if path is None:
                    raise ValueError("rows without a day have no file")
                buffer = io.BytesIO()
                with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
                    archive.writestr("readme.txt", "not this one")
                    member = path.rsplit("=", 1)[1].removesuffix(".zip").upper()
                    archive.writestr(member, "\n".join([top, *rows.to_pylist(), ""]))
                packed.append(put(f"{path}/{part:05d}-{k:05d}.zip", buffer.getvalue()))
                start = run
            yield pa.RecordBatch.from_arrays([pa.array(packed, pa.string())], names=["path"])

    _placed(raw, product, ordered, line).select(folder, "line").mapInArrow(pack, "path string").count()
    _settle(raw.sparkSession, draft, root, product)


def put(path: str, content: bytes) -> str:
    """Write one small file."""
    store, inner = located(path)
    store.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    with store.open_output_stream(inner, compression=None) as out:
        out.write(content)
    return path


def write_files(files: DataFrame) -> None:
    """Write every (path, content) row, text as UTF-8, as a file."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            done = [put(p, c.encode()) for p, c in zip(batch["path"], batch["content"], strict=True)]
            yield pd.DataFrame({"path": done}, dtype=object)

    files.select("path", "content").mapInPandas(write, "path string").count()
