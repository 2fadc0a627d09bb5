"""WARC archives: a writer of one gzip member per record, and a sequential reader."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator
from typing import BinaryIO

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REVISIT_BYTES = 1000
ARCHIVE_BYTES = 32_000_000
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


class WarcError(ValueError):
    """An archive that does not keep to its own framing or digests."""


def sha1_label(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def label_hex(label: str) -> str:
    return base64.b32decode(label.partition(":")[2]).hex()


def one_line(value: str) -> str:
    """A header value: line breaks and controls, which would end it, become spaces."""
    return "".join(c if c.isprintable() else " " for c in value).strip()


def record_bytes(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member of its own."""
    head = "WARC/1.1\r\n" + "".join(f"{k}: {one_line(v)}\r\n" for k, v in headers) + "\r\n"
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(head.encode() + block + b"\r\n\r\n") + squeeze.flush()


def page_record(
    page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str
) -> bytes:
    """A response record with the payload, or a revisit record that names one."""
    revisit = refers_to is not None
    http = HTTP_HEAD % len(payload)
    block = http if revisit else http + payload
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'page:{page_id}')}>"),
        ("WARC-Date", date),
    ]
    if url:
        headers.append(("WARC-Target-URI", url))
    if revisit:
        headers += [
            ("WARC-Profile", REVISIT_PROFILE),
            ("WARC-Refers-To", f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'page:{refers_to}')}>"),
            ("X-Refers-To-Page", str(refers_to)),
        ]
    headers += [
        ("WARC-Payload-Digest", sha1_label(payload)),
        ("WARC-Block-Digest", sha1_label(block)),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
        ("X-Payload-Length", str(len(payload))),
    ]
    if page_id is not None:
        headers.append(("X-Page-Id", str(page_id)))
    return record_bytes(headers, block)


def members(source: BinaryIO, piece: int = 65_536) -> Iterator[bytes]:
    """Inflate gzip members one after the other, reading ``piece`` bytes at a time."""
    at, data, inflate, out = 0, b"", None, []
    while data := data or source.read(piece):
        inflate = inflate or zlib.decompressobj(31)
        try:
            out.append(inflate.decompress(data))
        except zlib.error as e:
            raise WarcError(f"byte {at}: {e}") from e
        at, data = at + len(data) - len(inflate.unused_data), inflate.unused_data
        if inflate.eof:
            yield b"".join(out)
            inflate, out = None, []
    if inflate is not None:
        raise WarcError("archive ends inside a gzip member")


def parse_record(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and block of a record, framed by its length."""
    head, found, rest = member.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not found or not lines[0].startswith("WARC/1."):
        raise WarcError("no WARC header")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    length = int(headers.get("content-length", "-1"))
    if length < 0 or len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise WarcError(f"{headers.get('warc-record-id')}: content length does not frame the record")
    return headers, rest[:length]


def read_archive(source: BinaryIO) -> Iterator[dict]:
    """The records of an archive in order, with block and payload digests verified."""
    for member in members(source):
        headers, block = parse_record(member)
        record = headers.get("warc-record-id")
        if sha1_label(block) != headers["warc-block-digest"]:
            raise WarcError(f"{record}: block digest differs")
        _, _, payload = block.partition(b"\r\n\r\n")
        revisit = headers["warc-type"] == "revisit"
        if not revisit and sha1_label(payload) != headers["warc-payload-digest"]:
            raise WarcError(f"{record}: payload digest differs")
        refers, page = headers.get("x-refers-to-page"), headers.get("x-page-id")
        yield {
            "page_id": None if page is None else int(page),
            "payload_bytes": int(headers["x-payload-length"]) if revisit else len(payload),
            "payload_digest": label_hex(headers["warc-payload-digest"]),
            "record_type": headers["warc-type"],
            "refers_to": None if refers is None else int(refers),
            "url": headers.get("warc-target-uri"),
            "payload": None if revisit else payload,
        }


def with_revisits(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``payload`` and the page that each row refers to.

    Equal payloads are found by SHA-1 and length over narrow rows. Only groups of
    two or more are joined back, so that a payload held by a third of all rows is
    one row on the joined side and its pages can be split over tasks.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    rows = rows.withColumn("digest", F.when(F.length("payload") >= REVISIT_BYTES, F.sha1("payload")))
    groups = (
        rows.where("digest is not null")
        .groupBy("digest")
        .agg(F.max("page_id").alias("response_id"), F.count("*").alias("n"))
        .where("n > 1")
        .select(F.col("digest").alias("_digest"), "response_id")
    )
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("response_id")), F.col("response_id"))
    # Small payloads match nothing; a key of their own deals them evenly.
    own = F.concat(F.lit("-"), F.monotonically_increasing_id().cast("string"))
    keyed = rows.withColumn("digest", F.coalesce("digest", own))
    joined = keyed.join(groups, F.col("digest") == F.col("_digest"), "left")
    return joined.select("page_id", "url", "payload", refers.alias("refers_to"))


def open_folder(uri: str):
    """The file system of a shared folder as pyarrow sees it, and the path there."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def write_archives(pages: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write one record per page into ``folder``; returns a row per archive.

    Each task writes archives of about 32 MB compressed. An archive appears under
    its name in one rename, and the name carries the task attempt: only archives
    in the returned listing count, so a lost executor or a second attempt leaves
    no half-written or doubled records behind for the reader. The listing is the
    manifest; write it down before reading.
    """

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        context = TaskContext.get()
        store, root = open_folder(folder)
        stem = f"pages-{context.partitionId():06d}-{context.taskAttemptId()}"
        records, size, number = [], 0, 0

        def close() -> pd.DataFrame:
            name = f"{stem}-{number:05d}.warc.gz"
            with store.open_output_stream(f"{root}/.{name}.part") as out:
                for record in records:
                    out.write(record)
            store.move(f"{root}/.{name}.part", f"{root}/{name}")
            return pd.DataFrame({"archive": [name], "records": [len(records)], "bytes": [size]})

        for frame in frames:
            for page_id, url, payload, refers_to in frame.itertuples(index=False):
                record = page_record(whole(page_id), text(url), payload, whole(refers_to), date)
                records.append(record)
                size += len(record)
                if size >= ARCHIVE_BYTES:
                    yield close()
                    records, size, number = [], 0, number + 1
        if records:
            yield close()

    def whole(value) -> int | None:
        return None if value is None or value is pd.NA or value != value else int(value)

    def text(value) -> str | None:
        return value if isinstance(value, str) else None

    ids = [F.col(c).cast("string").alias(c) for c in ("page_id", "refers_to")]
    rows = with_revisits(pages).select(ids[0], "url", "payload", ids[1])
    return rows.mapInPandas(write, "archive string, records long, bytes long")


def read_archives(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """All records of the archives that ``manifest`` lists, one row each.

    An archive is streamed: a task holds one record and the rows it has not passed on.
    """

    def read(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = open_folder(folder)
        for frame in frames:
            for name in frame["archive"]:
                rows: list[dict] = []
                held = 0
                with store.open_input_stream(f"{root}/{name}", compression=None) as source:
                    for record in read_archive(source):
                        rows.append(record)
                        held += len(record["payload"] or b"")
                        if held > 8_000_000:
                            yield framed(rows)
                            rows, held = [], 0
                if rows:
                    yield framed(rows)

    def framed(rows: list[dict]) -> pd.DataFrame:
        frame = pd.DataFrame(rows, columns=COLUMNS)
        return frame.astype({"page_id": "Int64", "refers_to": "Int64"})

    return manifest.select("archive").mapInPandas(
        read,
        "page_id long, payload_bytes long, payload_digest string, record_type string, "
        "refers_to long, url string, payload binary",
    )


#: Tasks that read archives; beyond it a task reads several, one after the other.
MOST_TASKS = 20_000
COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"]


def roundtrip(pages: DataFrame, folder: str, manifest_path: str) -> DataFrame:
    """Archive all pages under ``folder`` and read every record back.

    Null html is an empty payload; a null url leaves the target out; line breaks
    and controls in a url become spaces. Of records with equal payloads of 1000
    bytes or more the largest page_id is a response, all others revisit it;
    repeated rows of that page_id are all responses; if all ids are null, so is
    each record. An empty table gives no archive and no row. Other columns of
    ``pages`` are ignored, whatever their names.
    """
    spark = pages.sparkSession
    store, root = open_folder(folder)
    store.create_dir(root, recursive=True)
    write_archives(pages, folder).write.parquet(manifest_path)
    manifest = spark.read.schema("archive string, records long, bytes long").parquet(manifest_path)
    return read_archives(spark, folder, spread(manifest))


def spread(manifest: DataFrame) -> DataFrame:
    """The listing in as many partitions as it has archives, up to ``MOST_TASKS``.

    With a number given, Spark does not merge the partitions of so small a table.
    """
    return manifest.repartition(max(1, min(manifest.count(), MOST_TASKS)), F.col("archive"))
