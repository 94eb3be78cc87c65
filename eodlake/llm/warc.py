"""WARC archives: a writer with revisit records, and a sequential reader.

Each record is a gzip member of its own. The reader streams a file in blocks, inflates one member
after the other, frames the payload by its content lengths and checks its digest. Tasks open archives
through the file system that the folder's address names, so a shared store works like a shared folder.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eodlake.llm.common import cut

BLOCK = 1 << 20
#: An archive is closed when it has so many compressed bytes, so that one task reads it in bounded time.
ARCHIVE_BYTES = 256 << 20
#: Equal payloads of at least so many bytes are written once.
REVISIT_BYTES = 1000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = (
    "record_id string, refers_to string, record_type string, target_uri string, payload_digest string, "
    "payload_bytes long, digest_ok boolean, payload binary"
)


def _b32(sha1: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1)).decode()


def _member(record_id: str, url: str, kind: str, sha1: str, refers_to: str | None, payload: bytes) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <{record_id}>",
        f"WARC-Target-URI: {' '.join(url.split())}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{_b32(sha1)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {PROFILE}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def revisits(pages: DataFrame, id_col: str = "page_id", payload: str = "html") -> DataFrame:
    """(digest, bytes, first_id) of payloads of REVISIT_BYTES or more that several ids share.

    first_id is the largest id. Only digests are shuffled, combined before the exchange.
    """
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    return (
        pages.where(F.octet_length(body) >= REVISIT_BYTES)
        .select(F.col(id_col).alias("id"), F.sha1(body).alias("digest"), F.octet_length(body).cast("long").alias("bytes"))
        .dropna()
        .groupBy("digest", "bytes")
        .agg(F.max("id").alias("first_id"), F.min("id").alias("last_id"))
        .where("first_id != last_id")
        .drop("last_id")
    )


def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Write a record per row of `pages` below `folder`; returns (archive, records) of what was written.

    Of equal payloads of REVISIT_BYTES or more, the one of the largest id is the response and the others
    refer to it. Null payloads are empty, null urls are written as empty; rows without an id are responses
    of their own. Record ids are `urn:page:<id>`. Rows whose id and payload repeat are all written alike. An empty table
    writes nothing. Further columns are not read.

    Lost or repeated tasks leave archives that nobody lists: only those of the result are part of it.
    """
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(url), F.lit("")).alias("url"), body.alias("body"), F.sha1(body).alias("digest")
    )
    shared = revisits(pages, id_col, payload)
    narrow = pages.select(
        F.col(id_col).cast("long").alias("id"), F.sha1(body).alias("digest"), F.octet_length(body).cast("long").alias("bytes")
    ).where(F.col("bytes") >= REVISIT_BYTES)
    # The decisions meet their rows by id, which is even; by digest, a common payload would gather in one task.
    later = (
        narrow.join(shared, ["digest", "bytes"])
        .where("id != first_id")
        .select("id", "digest", "first_id")
        .distinct()
    )
    decided = rows.join(later, ["id", "digest"], "left").select("id", "url", "body", "digest", "first_id")

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, name, records, size = None, "", 0, 0
        done: dict[str, list] = {"archive": [], "records": []}

        def close():
            out.close()
            done["archive"].append(name)
            done["records"].append(records)

        store, top = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for r in batch.to_pylist():
                if out is None:
                    name, records, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{top}/{name}", compression=None)
                kind = "response" if r["first_id"] is None else "revisit"
                member = _member(
                    f"urn:page:{'' if r['id'] is None else r['id']}", r["url"], kind, r["digest"],
                    None if r["first_id"] is None else f"urn:page:{r['first_id']}", r["body"],
                )
                out.write(member)
                records, size = records + 1, size + len(member)
                if size >= ARCHIVE_BYTES:
                    close()
                    out = None
        if out is not None:
            close()
        if done["archive"]:
            yield pa.RecordBatch.from_pydict(done, schema=pa.schema([("archive", pa.string()), ("records", pa.int64())]))

    fs.FileSystem.from_uri(folder)[0].create_dir(fs.FileSystem.from_uri(folder)[1], recursive=True)
    return cut(decided.mapInArrow(written, "archive string, records long"))


def members(stream) -> Iterator[bytes]:
    """The inflated bytes of each gzip member of a binary stream, read block by block."""
    engine, parts, block = zlib.decompressobj(31), [], stream.read(BLOCK)
    while block:
        parts.append(engine.decompress(block))
        if engine.eof:
            yield b"".join(parts)
            block = engine.unused_data or stream.read(BLOCK)
            engine, parts = zlib.decompressobj(31), []
        else:
            block = stream.read(BLOCK)
            if not block:
                raise ValueError("the archive ends inside a record")


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def parse(member: bytes) -> dict:
    """The record of a member; ValueError if its framing doesn't hold."""
    head, gap, rest = member.partition(b"\r\n\r\n")
    fields = _fields(head)
    length = int(fields.get("content-length", -1))
    if not gap or not head.startswith(b"WARC/") or not 0 <= length <= len(rest) or rest[length:] != b"\r\n\r\n":
        raise ValueError("a record's framing is broken")
    http, _, payload = rest[:length].partition(b"\r\n\r\n")
    sha1 = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
    size = int(_fields(http)["content-length"])
    revisit = fields["warc-type"] == "revisit"
    refers_to = fields.get("warc-refers-to")
    return {
        "record_id": fields["warc-record-id"].strip("<>"),
        "refers_to": refers_to and refers_to.strip("<>"),
        "record_type": fields["warc-type"],
        "target_uri": fields["warc-target-uri"],
        "payload_digest": sha1,
        "payload_bytes": size,
        "digest_ok": revisit or (len(payload) == size and hashlib.sha1(payload).hexdigest() == sha1),
        "payload": None if revisit else payload,
    }


def read_warc(archives: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """Every record of the listed archives, as RECORD. `archives`: (archive) names below `folder`.

    One task reads an archive from its start to its end and holds one record at a time. Revisits have a null
    payload; their length and digest are those of the payload they refer to. A payload that doesn't match its
    digest gives digest_ok false, a broken frame ends the job with an error. No archives give no rows.
    """
    schema = pa.schema(
        [(f.name, {"long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}.get(f.dataType.simpleString().replace("bigint", "long"), pa.string()))
         for f in _record_type()]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, size = [], 0
                with store.open_input_stream(f"{top}/{name}", compression=None) as stream:
                    for member in members(stream):
                        record = parse(member)
                        size += len(member)
                        rows.append(record if with_payload else record | {"payload": None})
                        if size > 16 * BLOCK:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    spread = archives.select("archive").repartition(max(1, min(10_000, archives.count())), "archive")
    return spread.mapInArrow(read, RECORD)


def _record_type():
    from pyspark.sql.types import StructType

    return StructType.fromDDL(RECORD)


def new_folder(spark) -> str:
    """A folder of its own below the shared checkpoint folder, as an address with a scheme."""
    from eodlake.session import checkpoint_root

    root = checkpoint_root(spark)
    return f"{root if '://' in root or root.startswith('file:') else 'file://' + root}/warc/{uuid.uuid4().hex}"
