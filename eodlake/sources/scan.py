"""Raw scan: day files -> all-text frames, one per header layout.

All CSV goes through Spark's own reader, which splits large files and reads only the columns in use; zipped
files are unpacked first (`archives.py`), so the same bytes give the same rows either way.
"""

from __future__ import annotations

import codecs
import csv
import hashlib
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eodlake.functions.text import col
from eodlake.sources.archives import member_blocks, task_count, unpack
from eodlake.sources.files import claimed_day
from eodlake.sources.streams import BLOCK, START, QuoteMap, RecordScan, blocks, located

CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "mode": "PERMISSIVE"}
EMPTY = "file is empty"
NOT_UTF8 = "not UTF-8"
#: Bytes of a plain file that one task scans.
RANGE = 1 << 28


def header_fields(header: str) -> list[str]:
    return next(csv.reader([header]), [])


def text_schema(fields: list[str]) -> T.StructType:
    """All-string schema under verbatim header names.

    Unnamed and repeated fields get a name no header can match, so the first of a name counts.
    """
    schema, seen = T.StructType(), set()
    for i, name in enumerate(fields):
        usable = name.strip() != "" and name.lower() not in seen
        seen.add(name.lower())
        schema.add(name if usable else f"__field_{i}", T.StringType())
    return schema


def _digest(path: str) -> tuple[str | None, str | None]:
    """(sha256, error) of the bytes of a file."""
    sha = hashlib.sha256()
    try:
        store, inner = located(path)
        with store.open_input_stream(inner, compression=None) as stream:
            for block in blocks(stream):
                sha.update(block)
        return sha.hexdigest(), None
    except (ValueError, OSError) as exc:
        return None, str(exc)


def _tasks(rows: DataFrame, *by: str) -> DataFrame:
    """A listing spread over tasks."""
    return rows.repartition(task_count(rows), *by)


def fingerprints(spark: SparkSession, parts: DataFrame) -> DataFrame:
    """Add (sha256, error) to resolved parts. A hash goes through a file from start to end, so one task reads it."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column(0).to_pylist()
            found = [_digest(p) for p in paths]
            columns = [pa.array(c, pa.string()) for c in (paths, [f[0] for f in found], [f[1] for f in found])]
            yield pa.RecordBatch.from_arrays(columns, names=["path", "sha256", "error"])

    return parts.join(_tasks(parts.select("path"), "path").mapInArrow(digest, "path string, sha256 string, error string"), "path")


class _Text:
    """Whether the bytes of a range are UTF-8. A character across two ranges counts with the first."""

    def __init__(self, first: bool):
        self._decoder = codecs.getincrementaldecoder("utf-8")()
        self._skip = 0 if first else 3  # bytes that may still belong to the range before
        self.good = True

    def feed(self, block: bytes, final: bool = False) -> None:
        while self._skip and block:
            if block[0] & 0xC0 == 0x80:
                block, self._skip = block[1:], self._skip - 1
            else:
                self._skip = 0
        try:
            self._decoder.decode(block, final)
        except UnicodeDecodeError:
            self.good = False


def _follow(source: Iterator[bytes], seen: RecordScan | QuoteMap, first: bool, rest: Callable[[], bytes] = bytes) -> str | None:
    """Lead a scan over a range; the error if it is not UTF-8. `rest` gives the bytes right behind the range."""
    text = _Text(first)
    for block in source:
        text.feed(block)
        if not text.good:
            return NOT_UTF8
        seen.feed(block)
    behind = rest()[:3]
    text.feed(behind[: len(behind) - len(behind.lstrip(_CONTINUED))], final=True)
    return None if text.good else NOT_UTF8


_CONTINUED = bytes(range(0x80, 0xC0))


def _range(path: str, offset: int, size: int) -> tuple:
    """(header, end, breaks, error) of a range of a plain file; the header only of the first one."""
    first = offset == 0
    seen = RecordScan() if first else QuoteMap()
    try:
        store, inner = located(path)
        with store.open_input_file(inner) as file:
            file.seek(offset)

            def upto() -> Iterator[bytes]:
                left = size
                while left and (block := file.read(min(BLOCK, left))):
                    left -= len(block)
                    yield block

            error = _follow(upto(), seen, first, lambda: file.read(3))
            if error or not first:
                return None, list(seen.end) if not first else None, list(seen.breaks) if not first else None, error
            end, breaks = seen.end, seen.breaks
            file.seek(offset + size)
            while not seen.headed and (block := file.read(BLOCK)):  # a header longer than the range
                seen.feed(block)
            return seen.header, [end] * 3, [breaks] * 3, None
    except (ValueError, OSError) as exc:
        return None, None, None, str(exc)


def _member(path: str, target: str | None) -> tuple:
    """The same of the CSV in an archive, written to `target` on the way."""
    seen = RecordScan()
    try:
        if target is None:
            error = _follow(member_blocks(path), seen, True)
        else:
            store, inner = located(target)
            store.create_dir(inner.rsplit("/", 1)[0], recursive=True)
            with store.open_output_stream(inner, compression=None) as out:

                def copied() -> Iterator[bytes]:
                    for block in member_blocks(path):
                        out.write(block)
                        yield block

                error = _follow(copied(), seen, True)
        return (None, None, None, error) if error else (seen.header, [seen.end] * 3, [seen.breaks] * 3, None)
    except (ValueError, OSError) as exc:
        return None, None, None, str(exc)


_RANGE_SCHEMA = "path string, offset long, header string, end array<int>, breaks array<boolean>, error string, data string"


def look(spark: SparkSession, parts: DataFrame, folder: str | None = None, size: int = RANGE) -> DataFrame:
    """Add (header, breaks, error, data) to resolved parts, plain and zipped, of any size.

    Plain files are scanned in ranges of `size` bytes by as many tasks: what quotes do to a range is a map between
    three states, and the maps of a file are joined in order. An archive is unpacked once, below `folder` if there is one,
    and scanned on the way. `data` is the plain file to read. A file that cannot be used says so in `error`.
    """
    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.string(), pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.bool_()), pa.string(), pa.string())
        names = [c.split()[0] for c in _RANGE_SCHEMA.split(", ")]
        for batch in batches:
            found = []
            for path, zipped, place, offset in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                data = path
                if zipped:
                    data = f"{folder}/{uuid.uuid4().hex}/{place}" if folder else None
                found.append((path, offset, *(_member(path, data) if zipped else _range(path, offset, size)), data))
            columns = list(zip(*found, strict=True)) or [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    # the place below the landing folder stays the same, as days are read from it
    place = F.concat_ws("/", F.col("product"), F.element_at(F.split("path", F.concat(F.lit("/"), F.col("product"), F.lit("/"))), -1)) if "product" in parts.columns else F.lit("")
    last = F.when(F.col("zipped"), F.lit(0)).otherwise(F.greatest(F.col("length") - 1, F.lit(0)))
    wanted = parts.select("path", "zipped", place.alias("place"), F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"), F.lit(size).cast("long"))).alias("offset"))
    looked = _tasks(wanted, "path", "offset").mapInArrow(ranges, _RANGE_SCHEMA)
    error = F.min(F.when(F.col("error").isNotNull(), F.struct("offset", "error"))).getField("error")
    steps = F.array_sort(F.collect_list(F.struct("offset", "end", "breaks")))
    files = looked.groupBy("path").agg(F.max("header").alias("header"), steps.alias("steps"), error.alias("error"), F.max("data").alias("data"))
    joined = F.aggregate(
        "steps", F.struct(F.lit(START).alias("at"), F.lit(False).alias("breaks")),
        lambda done, step: F.struct(step["end"][done["at"]].alias("at"), (done["breaks"] | step["breaks"][done["at"]]).alias("breaks")),
    ).getField("breaks")
    error = F.coalesce("error", F.when(F.col("header").isNull(), EMPTY))
    files = files.select(
        "path", F.when(error.isNull(), F.col("header")).alias("header"), (error.isNull() & joined).alias("breaks"), error.alias("error"), "data"
    )
    return parts.join(files, "path")


def inspect(spark: SparkSession, parts: DataFrame) -> DataFrame:
    """Add (sha256, header, breaks, error) to resolved parts, plain and zipped, of any size."""
    # side by side: on top of the hashes, every use of the listing would hash all files again
    hashed = fingerprints(spark, parts).select("path", "sha256", F.col("error").alias("unread"))
    found = look(spark, parts).join(hashed, "path").withColumn("error", F.coalesce("unread", "error"))
    return found.select(*parts.columns, "sha256", "header", "breaks", "error")


def unpacked(parts: DataFrame, folder: str) -> DataFrame:
    """Add `data`, the plain file to scan: the part itself, or its archive's member below `folder`."""
    usable = parts.where(F.col("zipped") & F.col("error").isNull())
    return parts.join(unpack(usable, folder), "path", "left").withColumn(
        "data", F.when(F.col("zipped"), F.col("data")).otherwise(F.col("path"))
    )


def _raw(df: DataFrame, product: str, path: Column, fields: list[Column], *order: Column):
    return df.select(
        claimed_day(path, product).alias("file_date"),
        F.struct(
            F.substring_index(path, "/", -1).alias("part"),
            *[o.alias(n) for o, n in zip(order, ("block", "line"), strict=True)],
        ).alias("row_no"),
        *fields,
    )


def scan_plain(
    spark: SparkSession, product: str, header: str, paths: list[str], breaks: bool = False
) -> DataFrame:
    """Plain files of one layout. Within a split lines come in file order, so (part, split start,
    running number) orders the rows of a day. Only files with `breaks` inside quotes are read
    unsplit."""
    schema = text_schema(header_fields(header))
    df = spark.read.schema(schema).options(**CSV_OPTIONS, multiLine=breaks).csv(paths)
    return _raw(
        df, product, F.col("_metadata.file_path"),
        [col(f.name) for f in schema],
        F.col("_metadata.file_block_start"), F.monotonically_increasing_id(),
    )


@dataclass(frozen=True)
class FileGroup:
    """Plain files that share a header; `breaks` = quoted fields hold line breaks."""

    header: str
    breaks: bool
    paths: list[str]


def groups_by_product(parts: DataFrame) -> dict[str, list[FileGroup]]:
    """Files to scan, by product and layout. File names go through the driver, as in any listing."""
    groups: dict[str, dict[tuple[str, bool], list[str]]] = {}
    for row in parts.where(F.col("error").isNull()).select("product", "header", "breaks", "data").collect():
        groups.setdefault(row["product"], {}).setdefault((row.header, row.breaks), []).append(row.data)
    return {p: [FileGroup(*key, sorted(paths)) for key, paths in sorted(of.items())] for p, of in groups.items()}


def group_by_layout(parts: DataFrame) -> list[FileGroup]:
    """Group unpacked parts of one product."""
    return next(iter(groups_by_product(parts).values()), [])


def scan_raw(spark: SparkSession, product: str, groups: list[FileGroup]) -> list[DataFrame]:
    """One raw frame per group: `file_date`, `row_no` and the verbatim header columns."""
    return [scan_plain(spark, product, g.header, g.paths, g.breaks) for g in groups]
