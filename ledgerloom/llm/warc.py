"""WARC archives: written in parallel, indexed by record, read back by coalesced byte ranges.

Every task writes one archive of its own (each record a gzip member, so that a byte
range of records can be read alone) and yields an index row for each record: path,
offset, length, URL and digest.  The index is committed by Spark, so an archive that
a lost or repeated task has left behind is in no index and is never read.

A reader takes the index rows of the records it wants, brings each archive's rows
together by stretch of the archive, sorts them by offset, and reads neighbours with
small gaps in one request.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.text import chunks
from ledgerloom.session import durable, shared_folder

#: bytes that may lie between two records of one read, and bytes of one read at most (a longer record is read alone)
GAP, LONGEST = 64 << 10, 8 << 20
#: bytes of an archive that one group of readers takes
STRETCH = 64 << 20
CRLF = b"\r\n"
INDEX = "page_id {id}, path string, offset bigint, length bigint, url string, digest string, record_type string"


def _place(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(path if "://" in path else f"file://{path.removeprefix('file:')}")


def _one_line(text: str | None) -> str:
    return " ".join((text or "").split())


def _record(kind: str, page_id: str, url: str | None, digest: str, size: int, body: bytes, refers_to: str | None) -> bytes:
    head = [b"WARC/1.1", b"WARC-Type: " + kind.encode(), b"WARC-Record-ID: <urn:page:" + page_id.encode() + b">",
            b"WARC-Date: 1970-01-01T00:00:00Z", b"WARC-Target-URI: " + _one_line(url).encode(),
            b"WARC-Payload-Digest: sha1:" + digest.encode(), b"WARC-Payload-Length: %d" % size, b"Content-Type: text/html; charset=utf-8"]
    if refers_to is not None:
        head += [b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 b"WARC-Refers-To: <urn:page:" + refers_to.encode() + b">"]
    head.append(b"Content-Length: %d" % len(body))
    return CRLF.join(head) + CRLF * 2 + body + CRLF * 2


def _gzip(raw: bytes) -> bytes:
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def decide(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(row, response, revisits): which row's record a row repeats, if any.

    ``pages`` has row, page_id, digest and n_bytes.  Of equal payloads the smallest page
    id is the response (a missing id comes last, then the smallest row).
    """
    first = durable(pages.where(F.col("n_bytes") >= least_bytes).groupBy("digest").agg(
        F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "row")).alias("f"), F.count(F.lit(1)).alias("n")).where(
        "n > 1").select("digest", F.col("f.page_id").alias("first_id"), F.col("f.row").alias("first_row")))
    same = pages.where(F.col("n_bytes") >= least_bytes).join(first, "digest")
    return same.where("row <> first_row").select("row", "first_id")


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 0) -> DataFrame:
    """Write one record for each row below ``folder``; the index that Spark has committed.

    A missing payload is empty.  A payload of at least ``least_bytes`` that several rows
    have is stored once, and the others are revisits without payload.  Rows that repeat
    the first one's id, URL and payload are responses like it.
    """
    given = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"),
                         F.coalesce(F.col(f"`{html}`"), F.lit("")).alias("t"))
    id_type = dict(given.dtypes)["page_id"]
    # a row's own number comes from its id and content, so that it is the same whenever the row is read
    keyed = given.withColumn("digest", F.sha1("t")).withColumn("n_bytes", F.octet_length("t")).withColumn(
        "row", F.concat_ws(" ", F.coalesce(F.col("page_id").cast("string"), F.lit("-")), "digest", F.sha1(F.coalesce("url", F.lit("-")))))
    revisits = decide(keyed.select("row", "page_id", "digest", "n_bytes"), least_bytes).groupBy("row").agg(
        F.first("first_id").alias("first_id"), F.lit(True).alias("revisit"))
    decided = keyed.select("row", "page_id", "url", "t").join(revisits, "row", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink, at, path = None, 0, f"{folder}/{uuid.uuid4().hex}.warc.gz"
        try:
            for b in chunks(batches, "t"):
                if sink is None:
                    files, local = _place(path)
                    files.create_dir(local.rsplit("/", 1)[0], recursive=True)
                    sink = files.open_output_stream(local, compression=None)
                rows = {k: [] for k in ("offset", "length", "digest", "record_type")}
                for page_id, link, text, revisit, first in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "t", "revisit", "first_id")), strict=True):
                    payload = text.encode()
                    digest, kind = sha1_base32(payload), "revisit" if revisit else "response"
                    raw = _gzip(_record(kind, str(page_id), link, digest, len(payload), b"" if revisit else payload, str(first) if revisit else None))
                    sink.write(raw)
                    for k, v in zip(rows, (at, len(raw), digest, kind), strict=True):
                        rows[k].append(v)
                    at += len(raw)
                yield pa.RecordBatch.from_arrays(
                    [b.column("page_id"), pa.array([path] * b.num_rows), pa.array(rows["offset"]), pa.array(rows["length"]),
                     b.column("url"), pa.array(rows["digest"]), pa.array(rows["record_type"])],
                    ["page_id", "path", "offset", "length", "url", "digest", "record_type"])
        finally:
            if sink is not None:
                sink.close()

    return durable(decided.select("page_id", "url", "t", "revisit", "first_id").mapInArrow(run, INDEX.format(id=id_type)))


def ranges(offset: np.ndarray, length: np.ndarray, gap: int = GAP, longest: int = LONGEST) -> list[tuple[int, int]]:
    """(first, one past the last) of records, sorted by offset, that one read takes."""
    out, first = [], 0
    for i in range(1, len(offset) + 1):
        if i == len(offset) or offset[i] - (offset[i - 1] + length[i - 1]) > gap or offset[i] + length[i] - offset[first] > longest:
            out.append((first, i))
            first = i
    return out


def _parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, body = raw.partition(CRLF * 2)
    fields = dict(line.decode().split(": ", 1) if ": " in line.decode() else (line.decode().rstrip(":"), "") for line in head.split(CRLF)[1:])
    return fields, body[: int(fields["Content-Length"])]


def read(index: DataFrame, payload: bool = True) -> DataFrame:
    """The records of the given index rows: page_id, url, record_type, refers_to, digest, n_bytes (of the whole
    payload, also for a revisit) and, if asked, the stored payload.

    A record whose payload doesn't have its digest raises.  An empty index gives no rows, a
    row that is asked for twice is read twice, and missing page ids stay missing.
    """
    id_type = dict(index.dtypes)["page_id"]
    stretch = index.withColumn("stretch", F.floor(F.col("offset") / STRETCH))
    dealt = stretch.repartition("path", "stretch").sortWithinPartitions("path", "offset").select(
        "page_id", "path", "offset", "length", "digest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            paths = b.column("path").to_pylist()
            offset, length = (b.column(c).to_numpy(zero_copy_only=False) for c in ("offset", "length"))
            said = b.column("digest").to_pylist()
            cuts = [0, *(i for i in range(1, len(paths)) if paths[i] != paths[i - 1]), len(paths)]
            for s, e in zip(cuts, cuts[1:], strict=False):
                if s == e:
                    continue
                files, local = _place(paths[s])
                with files.open_input_file(local) as source:
                    for first, last in ranges(offset[s:e], length[s:e]):
                        first, last = first + s, last + s
                        begin = int(offset[first])
                        block = source.read_at(int(offset[last - 1] + length[last - 1]) - begin, begin)
                        rows = []
                        for i in range(first, last):
                            at = int(offset[i]) - begin
                            fields, body = _parse(zlib.decompress(block[at: at + int(length[i])], 31))
                            digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                            if digest != said[i] or fields["WARC-Type"] == "response" and sha1_base32(body) != digest:
                                raise ValueError(f"damaged record at {paths[i]}:{offset[i]}")
                            to = fields.get("WARC-Refers-To", "").removeprefix("<urn:page:").removesuffix(">")
                            rows.append((fields["WARC-Target-URI"], fields["WARC-Type"], to or None, digest, int(fields["WARC-Payload-Length"]), body if payload else None))
                        cols = list(zip(*rows, strict=True))
                        yield pa.RecordBatch.from_arrays(
                            [b.column("page_id").slice(first, last - first), pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()),
                             pa.array(cols[2], pa.string()), pa.array(cols[3], pa.string()), pa.array(cols[4], pa.int64()), pa.array(cols[5], pa.binary())],
                            ["page_id", "url", "record_type", "refers_to", "digest", "n_bytes", "payload"])

    return dealt.mapInArrow(run, f"page_id {id_type}, url string, record_type string, refers_to string, digest string, n_bytes bigint, payload binary")


def folder_for(pages: DataFrame) -> str:
    return shared_folder(pages.sparkSession)
