"""WARC archives of pages: one gzip member a record, written by tasks and read back by byte ranges.

Pages with equal payloads share one response record; the others are revisit records that refer to it and hold the HTTP
header only. A reading task looks for gzip magic in its range. A candidate counts as a record if it decodes, begins with a
WARC header and has the length that the header states; so bytes inside a record that look like a member do not. The task
owns the records that start in its range and reads on beyond its end to finish the last. Members written here also state
their own offset in the gzip header, so that an archive inside a payload cannot be taken for records.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillworks.llm.storage import open_folder, scratch, stored

MAGIC = b"\x1f\x8b\x08"
FILE_BYTES, RANGE_BYTES, CHUNK = 256 << 20, 16 << 20, 1 << 14
MOST_TASKS = 20_000  # ranges beyond that share tasks
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_WRITTEN = "file string, bytes long, records long"


def gzip_member(data: bytes, offset: int, level: int = 3) -> bytes:
    squeeze = zlib.compressobj(level, zlib.DEFLATED, -15)
    extra = struct.pack("<2sHQ", b"OF", 8, offset)
    head = MAGIC + struct.pack("<BIBBH", 4, 0, 0, 255, len(extra)) + extra
    return head + squeeze.compress(data) + squeeze.flush() + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def _stated_offset(head: bytes) -> int | None:
    """The offset that a member states in its gzip header, if any."""
    if len(head) < 12 or not head[3] & 4:
        return None
    extra, at = head[12 : 12 + struct.unpack_from("<H", head, 10)[0]], 0
    while at + 4 <= len(extra):
        name, n = struct.unpack_from("<2sH", extra, at)
        if name == b"OF" and n == 8 and at + 12 <= len(extra):
            return struct.unpack_from("<Q", extra, at + 4)[0]
        at += 4 + n
    return None


def record(fields: dict[str, str | None], block: bytes) -> bytes:
    lines = [f"{k}: {v}".replace("\r", "%0D").replace("\n", "%0A") for k, v in fields.items() if v is not None]
    head = "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(block)}"])
    return head.encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes] | None:
    """Header fields (lower-cased names) and block of a decoded member; None if it isn't a whole WARC record."""
    head, mark, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.split(b"\r\n")
    if not mark or not first.startswith(b"WARC/1."):
        return None
    pairs = (line.decode("utf-8", "replace").partition(":") for line in lines)
    fields = {k.strip().lower(): v.strip() for k, _, v in pairs}
    n = fields.get("content-length", "")
    if not n.isdigit() or len(rest) != int(n) + 4 or not rest.endswith(b"\r\n\r\n"):
        return None
    return fields, rest[:-4]


class Archive:
    """Records of an open file by offset."""

    def __init__(self, file, own_only: bool) -> None:
        self.file, self.own_only = file, own_only
        self.at, self.block = 0, b""

    def read(self, at: int, n: int) -> bytes:
        if not self.at <= at <= at + n <= self.at + len(self.block):
            self.file.seek(at)
            self.at, self.block = at, self.file.read(max(n, 1 << 20))
        return self.block[at - self.at : at - self.at + n]

    def candidate(self, start: int, end: int) -> int | None:
        """The first offset in [start, end) at which gzip magic stands."""
        while start < end:
            block = self.read(start, min(1 << 20, end - start) + len(MAGIC) - 1)
            found = block.find(MAGIC)
            if found >= 0:
                return start + found
            if len(block) < len(MAGIC):
                return None
            start += len(block) - len(MAGIC) + 1
        return None

    def member(self, start: int) -> tuple[dict[str, str], bytes, int] | None:
        """Fields, block and end of the record at an offset; None if there is none."""
        stated = _stated_offset(self.read(start, CHUNK))
        if stated != start and (stated is not None or self.own_only):
            return None
        decoder, parts, at, seen = zlib.decompressobj(31), [], start, 0
        while not decoder.eof:
            chunk = self.read(at, CHUNK)
            if not chunk:
                return None
            try:
                parts.append(decoder.decompress(chunk))
            except zlib.error:
                return None
            if seen < 7 <= (seen := seen + len(parts[-1])) and not b"".join(parts).startswith(b"WARC/1."):
                return None
            at += len(chunk)
        parsed = parse(b"".join(parts))
        return parsed and (*parsed, at - len(decoder.unused_data))

    def records(self, start: int, end: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
        """Offset, fields and block of the records that start in [start, end)."""
        at = start
        while (at := self.candidate(at, end)) is not None:
            found = self.member(at)
            if found:
                yield at, found[0], found[1]
            at = found[2] if found else at + 1


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _http(payload: bytes, with_payload: bool) -> bytes:
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    return head.encode() + (payload if with_payload else b"")


def _writer(folder: str, date: str, file_bytes: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        system, base = open_folder(folder)
        system.create_dir(base, recursive=True)
        out, name, at, count, written = None, "", 0, 0, []

        def close() -> None:
            if out is not None:
                out.close()
                written.append((f"{folder}/{name}", at, count))

        for batch in batches:
            columns = (batch.column(c) for c in ("row_id", "page_id", "url", "payload", "response_row", "response_page"))
            for row_id, page, url, payload, response_row, response_page in zip(*(c.to_pylist() for c in columns)):
                if out is None or at >= file_bytes:
                    close()
                    name = f"pages-{task.partitionId():06d}-{task.taskAttemptId()}-{len(written):04d}.warc.gz"
                    out, at, count = system.open_output_stream(f"{base}/{name}", compression=None), 0, 0
                digest = base32_sha1(payload)
                fields = {
                    "WARC-Type": "response", "WARC-Record-ID": f"<urn:page:{'' if page is None else page}:{row_id}>",
                    "WARC-Target-URI": url, "WARC-Date": date, "WARC-Payload-Digest": f"sha1:{digest}",
                    "Content-Type": "application/http; msgtype=response",
                }
                if revisit := response_row is not None and response_row != row_id:
                    same = f"<urn:page:{'' if response_page is None else response_page}:{response_row}>"
                    fields |= {"WARC-Type": "revisit", "WARC-Refers-To": same, "WARC-Profile": PROFILE}
                data = gzip_member(record(fields, _http(payload, not revisit)), at)
                out.write(data)
                at, count = at + len(data), count + 1
        close()
        columns = zip(*written) if written else [()] * 3
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64()))], ["file", "bytes", "records"]
        )

    return run


def write_archives(
    pages: DataFrame, folder: str | None = None, min_bytes: int = 0, date: str = "2000-01-01T00:00:00Z",
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Write a record for each row of a stored table with ``page_id``, ``url`` and ``html``; return ``file``, ``bytes``,
    ``records`` of each archive. Only files named there count: a task that runs again writes new ones.

    The payload is the html in UTF-8, empty for null. Of rows with equal payloads of at least ``min_bytes`` that with the
    largest page_id (null last), then row, is the response. Repeated rows are records of their own. A null url is left out
    of the record. Further columns are ignored. An empty table gives no file.
    """
    folder = folder or scratch(pages.sparkSession, "warc")
    payload = F.coalesce("html", F.lit("")).cast("binary")
    source = pages.select(F.monotonically_increasing_id().alias("row_id"), "page_id", "url", payload.alias("payload"))
    source = source.withColumn("digest", F.unhex(F.sha1("payload")))
    long_enough = source.where(F.length("payload") >= min_bytes).select("digest", "page_id", "row_id")
    groups = long_enough.groupBy("digest", "page_id").agg(F.max("row_id").alias("row"), F.count("*").alias("n"))
    groups = groups.groupBy("digest").agg(
        F.coalesce(F.max_by("row", "page_id"), F.max("row")).alias("response_row"),
        F.max("page_id").alias("response_page"), F.sum("n").alias("n"),
    )
    groups = stored(groups.where("n > 1").drop("n"), "equal-payloads")
    rows = source.join(groups, "digest", "left").drop("digest")
    return stored(rows.mapInArrow(_writer(folder, date, file_bytes), _WRITTEN), "archives")


_RECORD = {
    "file": pa.string(), "offset": pa.int64(), "record_id": pa.string(), "record_type": pa.string(), "target_uri": pa.string(),
    "warc_date": pa.string(), "refers_to": pa.string(), "payload_digest": pa.string(), "payload_bytes": pa.int64(),
    "payload": pa.binary(),
}
_READ = (
    "file string, offset long, record_id string, record_type string, target_uri string, warc_date string, refers_to string, "
    "payload_digest string, payload_bytes long, payload binary"
)


def _described(fields: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    payload, stated = block, fields.get("payload-length", "")
    if fields.get("content-type", "").startswith("application/http"):
        head, _, payload = block.partition(b"\r\n\r\n")
        lines = (line.partition(b":") for line in head.split(b"\r\n")[1:])
        stated = next((v.strip().decode() for k, _, v in lines if k.strip().lower() == b"content-length"), "")
    revisit = fields.get("warc-type") == "revisit"
    digest = fields.get("warc-payload-digest", "").rpartition(":")[2] if revisit else base32_sha1(payload)
    n = int(stated) if revisit and stated.isdigit() else len(payload)
    names = ("warc-record-id", "warc-type", "warc-target-uri", "warc-date", "warc-refers-to")
    values = [fields.get(k) for k in names]
    for k in (0, 4):
        values[k] = values[k].strip("<>") if values[k] else None
    return (*values, digest, n, payload if with_payload and not revisit else None)


def _range_reader(with_payload: bool, own_only: bool, batch_bytes: int = 8 << 20):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _RECORD.values())], list(_RECORD))

        rows, held = [], 0
        for batch in batches:
            for path, start, end in zip(*(batch.column(c).to_pylist() for c in ("file", "start", "end"))):
                system, bare = open_folder(path)
                with system.open_input_file(bare) as file:
                    for at, fields, block in Archive(file, own_only).records(start, end):
                        rows.append((path, at, *_described(fields, block, with_payload)))
                        held += 200 + len(block) * with_payload
                        if held > batch_bytes:
                            yield made(rows)
                            rows, held = [], 0
        if rows:
            yield made(rows)

    return run


def read_archives(files: DataFrame, range_bytes: int = RANGE_BYTES, with_payload: bool = True, own_only: bool = False) -> DataFrame:
    """The records of archives given as ``file`` and ``bytes``, each from the task in whose byte range it starts.

    ``payload_digest`` is computed from the payload (base32 SHA-1) and, like ``payload_bytes``, taken from the headers of a
    revisit. With ``own_only`` a member has to state its offset, as those of ``write_archives`` do. Bytes that are no record
    are passed over. An empty file or table gives no row.
    """
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(range_bytes).cast("long")))
    ranges = files.where("bytes > 0").select("file", "bytes", starts.alias("start"))
    ranges = ranges.select("file", "start", F.least(F.col("start") + range_bytes, F.col("bytes")).alias("end"))
    tasks = files.agg(F.sum(F.ceil(F.col("bytes") / range_bytes))).first()[0] or 1
    return ranges.repartition(int(min(tasks, MOST_TASKS))).mapInArrow(_range_reader(with_payload, own_only), _READ)


def page_of(record_id: Column) -> Column:
    """The page_id in the name of a record written here."""
    return F.nullif(F.regexp_extract(record_id, r"^urn:page:(-?\d*):", 1), F.lit("")).cast("long")


def archived(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write the pages and read them back: one row for each, without payload."""
    records = read_archives(write_archives(pages), with_payload=False, own_only=True)
    return records.select(
        page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        page_of(F.col("refers_to")).alias("refers_to"),
    )


ORACLE = """
WITH hashed AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
encoded AS (
  SELECT page_id, payload_bytes, hex, list_aggregate(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      ((('0x' || substr(hex, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INTEGER + 1, 1)), 'string_agg', '')
    AS payload_digest
  FROM hashed),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY hex ORDER BY page_id DESC NULLS LAST) AS place,
    max(page_id) OVER (PARTITION BY hex) AS response
  FROM encoded)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN place > 1 THEN response END AS refers_to
FROM ranked
"""
