"""Zip archives: the one input Spark cannot read, so a task unpacks them to plain files that it can.

An archive goes through a task block by block and is never held as a whole, packed or unpacked.
"""

from __future__ import annotations

import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from eodlake.sources.streams import blocks, located

NO_CSV = "no CSV found in archive"
DAMAGED = (zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError, RuntimeError)


def find_member(archive: zipfile.ZipFile, inner_name: str | None = None) -> str | None:
    """The named member, in any case, or else the first CSV."""
    names = [n for n in archive.namelist() if not n.endswith("/")]
    if inner_name:
        wanted = [n for n in names if n.lower() == inner_name.lower()]
    else:
        wanted = [n for n in names if n.lower().endswith(".csv")]
    return wanted[0] if wanted else None


def member_blocks(path: str, inner_name: str | None = None) -> Iterator[bytes]:
    """The bytes of the CSV member, checked to its end; ValueError if there is none or it is damaged."""
    store, inner = located(path)
    try:
        with store.open_input_file(inner) as file, zipfile.ZipFile(file) as archive:
            member = find_member(archive, inner_name)
            if member is None:
                raise ValueError(NO_CSV)
            with archive.open(member) as stream:
                yield from blocks(stream)
    except DAMAGED as exc:
        raise ValueError(f"unreadable archive: {exc}") from exc


def task_count(files: DataFrame) -> int:
    """Tasks to spread a listing over: a task for each file, up to some for each core."""
    return max(1, min(files.count(), 4 * files.sparkSession.sparkContext.defaultParallelism))


def unpack(archives: DataFrame, folder: str) -> DataFrame:
    """(path, data) of (product, path) rows: where each archive's CSV now lies below `folder`.

    The place below the product stays the same. Every attempt writes to a folder of its own, and only those
    of the result are read. Lazy: keep the result, or each use unpacks again.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for product, path in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                place = path.rsplit(f"/{product}/", 1)[1]
                data = f"{folder}/{uuid.uuid4().hex}/{product}/{place}"
                store, inner = located(data)
                store.create_dir(inner.rsplit("/", 1)[0], recursive=True)
                with store.open_output_stream(inner, compression=None) as out:
                    for block in member_blocks(path):
                        out.write(block)
                found.append(data)
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, pa.string())], names=["path", "data"])

    return archives.select("product", "path").repartition(task_count(archives), "path").mapInArrow(write, "path string, data string")
