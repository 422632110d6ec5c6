"""WARC archives: a writer and a splittable reader.

Writing: every record is a gzip member of its own. Tasks write files below one
folder under names of their own try, and hand back what they wrote; only files
that reached the resulting table are read, so retried tasks leave no doubles.

Reading: files are cut into byte ranges, one task reads many. In its range a
task looks for the gzip magic and accepts a candidate if its first bytes
decode to a WARC header; from there it follows member after member. It owns
the records that start in its range, and reads the last one to its end beyond
the range. A member found inside the body of a record that an earlier range
owns (an archive within an archive) is told by the end of that record and left out.

Archives lie where ``pyarrow.fs`` reaches them: local or mounted folders,
hdfs, s3 or gs. Tables are read by Spark alone.

Defined results: null html is the empty payload. Of rows with equal payloads
of at least ``min_bytes`` the one with the largest id is the response and the
others refer to it; rows equal in id and payload are written alike. A null id
is smaller than any other. Extra columns are ignored. No rows: no files, an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources import shared_folder
from .common import stored

#: Fixed values of the format.
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_ID = "urn:row:"
DATE = "2024-01-01T00:00:00Z"

RANGE_BYTES = 16 << 20
CHUNK = 1 << 20
#: Decoded bytes that tell whether a member is a WARC record; its header may be longer.
PEEK = 1 << 16

_WRITTEN = "path string, length long"
_RECORD = (
    "path string, range_no long, start long, stop long, record_type string, record_id long, refers_to long, "
    "target string, payload_bytes long, payload_digest string, intact boolean, payload binary"
)


def _opened(url: str):
    """(file system, path) of a URL or a plain path."""
    return fs.FileSystem.from_uri(url if ":" in url.split("/")[0] else f"file://{url}")


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(row_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A gzip member with one record: a revisit if it refers to another row, else a response."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<{RECORD_ID}{'' if row_id is None else row_id}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", quote(url or "", safe=":/?#[]@!$&'()*+,;=%~-._")),
        ("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if refers_to is not None:
        fields += [("WARC-Refers-To", f"<{RECORD_ID}{refers_to}>"), ("WARC-Profile", PROFILE)]
    head = VERSION + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head + block + b"\r\n\r\n") + packer.flush()


def write_warc(pages: DataFrame, folder: str, min_bytes: int = 0, row_id: str = "page_id") -> DataFrame:
    """Write a record per row of ``pages`` (``row_id``, url, html); rows (path, length) of the files, already stored."""
    rows = pages.select(
        F.col(row_id).cast("long").alias("row_id"), "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload")
    ).withColumn("same", F.when(F.length("payload") >= min_bytes, F.sha2("payload", 256)))
    groups = rows.groupBy("same").agg(F.max("row_id").alias("newest"))
    rows = rows.join(stored(groups, "warc-payloads"), "same", "left").withColumn(
        "refers_to", F.when(~F.col("row_id").eqNullSafe(F.col("newest")), F.col("newest"))
    ).select("row_id", "url", "payload", "refers_to")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, base = _opened(folder)
        name, out, length = f"part-{uuid.uuid4().hex}.warc.gz", None, 0
        for pdf in batches:
            for i, url, payload, to in zip(pdf["row_id"], pdf["url"], pdf["payload"], pdf["refers_to"]):
                if out is None:
                    files.create_dir(base, recursive=True)
                    out = files.open_output_stream(f"{base}/{name}", compression=None)
                member = record(None if pd.isna(i) else int(i), url, payload, None if pd.isna(to) else int(to))
                out.write(member)
                length += len(member)
        if out is not None:
            out.close()
            yield pd.DataFrame({"path": [f"{folder}/{name}"], "length": [length]})

    return stored(rows.mapInPandas(write, _WRITTEN), "warc-files")


class _Window:
    """Bytes of a file from ``at`` on, read as far as they are asked for."""

    def __init__(self, handle, size: int):
        self.handle, self.size = handle, size

    def read(self, at: int, n: int) -> bytes:
        if at >= self.size:
            return b""
        self.handle.seek(at)
        return self.handle.read(min(n, self.size - at))


def _member(window: _Window, at: int) -> tuple[bytes, int] | None:
    """(content, end) of the WARC member at ``at``; None if there is none."""
    unpacker, parts, seen, pos = zlib.decompressobj(31), [], 0, at
    try:
        while not unpacker.eof:
            chunk = window.read(pos, CHUNK)
            if not chunk:
                return None  # cut off
            pos += len(chunk)
            got = unpacker.decompress(chunk, 0 if seen >= len(VERSION) else PEEK)
            parts.append(got)
            seen += len(got)
            if seen >= len(VERSION):
                if len(parts) <= 2 and not b"".join(parts).startswith(b"WARC/1."):
                    return None
                if unpacker.unconsumed_tail:
                    parts.append(unpacker.decompress(unpacker.unconsumed_tail))
    except zlib.error:
        return None
    return b"".join(parts), pos - len(unpacker.unused_data)


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, _, v in pairs if k}


def _row_id(text: str | None) -> int | None:
    digits = (text or "").strip("<>").removeprefix(RECORD_ID)
    return int(digits) if digits.lstrip("-").isdigit() else None


def parse(content: bytes) -> dict | None:
    """Columns of a record; None if it isn't one."""
    if not content.startswith(b"WARC/1.") or (cut := content.find(b"\r\n\r\n")) < 0:
        return None
    head = _fields(content[:cut])
    if not head.get("content-length", "").isdigit() or "warc-type" not in head:
        return None
    block = content[cut + 4 : cut + 4 + int(head["content-length"])]
    http = block.find(b"\r\n\r\n")
    http_head = _fields(block[:http]) if http >= 0 else {}
    payload = block[http + 4 :] if http >= 0 else block
    declared = head.get("warc-payload-digest", "").removeprefix("sha1:")
    whole = len(block) == int(head["content-length"])
    out = {
        "record_type": head["warc-type"],
        "record_id": _row_id(head.get("warc-record-id")),
        "refers_to": _row_id(head.get("warc-refers-to")),
        "target": head.get("warc-target-uri"),
    }
    if head["warc-type"] == "revisit":  # what it stands for is told by the headers kept with it
        length = http_head.get("content-length", "")
        return out | {"payload_bytes": int(length) if length.isdigit() else None, "payload_digest": declared, "intact": whole, "payload": None}
    digest = payload_digest(payload)
    return out | {"payload_bytes": len(payload), "payload_digest": digest, "intact": whole and declared in ("", digest), "payload": payload}


def read_range(window: _Window, start: int, stop: int) -> Iterator[dict]:
    """The records that start in [start, stop)."""
    at = start
    while at < stop:
        found = _member(window, at) if window.read(at, 3) == MAGIC else None
        columns = parse(found[0]) if found else None
        if columns:
            yield columns | {"start": at, "stop": found[1]}
            at = found[1]
            continue
        at += 1
        while at < stop:  # the next candidate; a magic may run over the end of a chunk
            chunk = window.read(at, min(CHUNK, stop - at) + len(MAGIC) - 1)
            hit = chunk.find(MAGIC)
            if hit >= 0:
                at += hit
                break
            at += max(1, len(chunk) - len(MAGIC) + 1)
        else:
            return


def read_warc(files: DataFrame, range_bytes: int = RANGE_BYTES, with_payload: bool = True) -> DataFrame:
    """Records of the archives in ``files`` (path, length); see ``_RECORD`` for the columns."""
    last = F.floor((F.col("length") - 1) / range_bytes)
    ranges = files.where("length > 0").select("path", "length", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("range_no"))
    n = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, length, no in zip(pdf["path"], pdf["length"], pdf["range_no"]):
                files, own = _opened(path)
                with files.open_input_file(own) as handle:
                    rows, held = [], 0
                    for r in read_range(_Window(handle, length), no * range_bytes, min(length, (no + 1) * range_bytes)):
                        held += len(r["payload"] or b"")
                        rows.append(r | {"path": path, "range_no": no} | ({} if with_payload else {"payload": None}))
                        if held > RANGE_BYTES:
                            yield _frame(rows)
                            rows, held = [], 0
                    if rows:
                        yield _frame(rows)

    def _frame(rows: list[dict]) -> pd.DataFrame:
        names = [part.split()[0] for part in _RECORD.split(", ")]
        pdf = pd.DataFrame(rows, columns=names)
        return pdf.astype({k: "Int64" for k in ("record_id", "refers_to", "payload_bytes")})

    found = ranges.repartition(n, "path", "range_no").mapInPandas(read, _RECORD)
    if not with_payload:
        found = stored(found, "warc-records")
    # Where the records of earlier ranges of the file end: whatever starts before that is inside one of them.
    ends = found.groupBy("path", "range_no").agg(F.max("stop").alias("stop"))
    reach = ends.selectExpr(
        "path", "range_no",
        "max(stop) OVER (PARTITION BY path ORDER BY range_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach",
    )
    return found.join(reach, ["path", "range_no"]).where("reach IS NULL OR start >= reach").drop("reach")


def warc_round_trip(spark: SparkSession, pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as archives in the shared folder and read the records back, without payloads."""
    return read_warc(write_warc(pages, shared_folder(spark, "warc"), min_bytes), with_payload=False)
