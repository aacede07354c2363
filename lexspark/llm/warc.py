"""Operator 6: writes WARC archives and reads them back, salvaging what damage leaves.

Writing: of records with equal payloads of at least MIN_BYTES, the one with the smallest page_id is
a response that holds the payload, the others are revisits that refer to it. Tasks write gzip
members, one a record, to archives of bounded size in the shared folder, under a temporary name
that becomes final by a rename. Names hold the attempt's number, so no attempt overwrites another's
archives, and the log that is returned names those of the attempts that count.

Reading: archives are read in blocks of bytes, a member at a time, its payload hashed as it passes
and held only if it is asked for, so a record may be of any length. A member whose check sum,
header or length is wrong, and anything that is no member, is quarantined: the reader looks for
the next gzip magic that opens a valid record, or the next version line of an uncompressed record,
goes on from there, and logs the gap of bytes it left out.

Defined results: null html is an empty payload; a null or odd url is written percent-encoded or
left out; rows with equal page_id and payload are equal records: all responses if that page_id is
the smallest; a null page_id counts as larger than any other; an empty table writes no archive and
gives no rows; only page_id, url and html are read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexspark.llm.common import Scratch, checked_broadcast

MIN_BYTES = 0
#: Bytes of compressed records after which a task begins another archive.
ROLL = 64 << 20
BLOCK = 1 << 20
VERSION = b"WARC/1.1"
MAGIC = b"\x1f\x8b\x08"
RECORD = "path string, start long, end long, problem string, record_type string, page_id long, url string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """A WARC record of an HTTP response, or a revisit that holds its head alone."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head if revisit else head + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"), ("WARC-Date", "2000-01-01T00:00:00Z")]
    if url:
        fields.append(("WARC-Target-URI", re.sub(r"[^\x21-\x7e]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode("utf-8", "replace")), url)))
    fields += [("WARC-Payload-Digest", f"sha1:{digest_of(payload)}"), ("X-Payload-Length", str(len(payload)))]
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if revisit:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("X-Refers-To-Page-ID", str(refers_to))]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def _temporary(root: str, partition: int, number: int, attempt: int) -> str:
    """A name that read_warc's pattern cannot match, for what a lost attempt leaves behind."""
    return f"{root}/_{partition:05d}-{number:04d}.{attempt}.tmp"


def _writer(folder: str, roll: int):
    """(page_id, url, html, first, revisit) to (path, bytes, records)."""

    def run(batches):
        import pyarrow as pa
        from pyarrow import fs as pafs
        from pyspark import TaskContext

        fs, root = pafs.FileSystem.from_uri(folder)
        task = TaskContext.get()
        made, out = [], None

        def close():
            stream, name, temporary, size, records = out
            stream.close()
            fs.move(temporary, name)
            made.append((f"{folder}{name.removeprefix(root)}", size, records))

        for batch in batches:
            for page, url, html, first, revisit in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                if out is None:
                    fs.create_dir(root, recursive=True)
                    name = f"{root}/part-{task.partitionId():05d}-{len(made):04d}-{task.taskAttemptId()}.warc.gz"
                    temporary = _temporary(root, task.partitionId(), len(made), task.taskAttemptId())
                    out = [fs.open_output_stream(temporary, compression=None), name, temporary, 0, 0]
                data = _member(record_bytes(page, url, (html or "").encode(), first, revisit))
                out[0].write(data)
                out[3] += len(data)
                out[4] += 1
                if out[3] >= roll:
                    close()
                    out = None
        if out is not None:
            close()
        columns = list(zip(*made, strict=True)) if made else [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())], names=["path", "bytes", "records"])

    return run


def write_warc(pages: DataFrame, folder: str, min_bytes: int = MIN_BYTES, roll: int = ROLL) -> DataFrame:
    """Writes the pages' records below folder, a URI that all executors reach; (path, bytes, records) of the archives."""
    # Only digests that occur twice are joined: by broadcast where they are few, so payloads are not shuffled.
    keyed = pages.select("page_id", "url", "html", F.sha1(F.coalesce("html", F.lit("")).cast("binary")).alias("digest"), F.octet_length(F.coalesce("html", F.lit(""))).alias("size"))
    scratch = Scratch(pages.sparkSession, "warc-log")
    firsts = keyed.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").select("digest", "first", F.lit(True).alias("again"))
    firsts = checked_broadcast(scratch.store(firsts, "repeated"), 120)
    joined = keyed.join(firsts, "digest", "left")
    revisit = F.coalesce("again", F.lit(False)) & (F.col("size") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("first"))
    rows = joined.select("page_id", "url", "html", F.when(revisit, F.col("first")).alias("first"), revisit.alias("revisit"))
    written = rows.mapInArrow(_writer(folder, roll), "path string, bytes long, records long")
    return scratch.store(written, "archives")


class _Bytes:
    """Bytes of a seekable file by offset, through one cached window."""

    def __init__(self, file) -> None:
        self.file, self.size, self.start, self.window = file, file.size(), 0, b""

    def at(self, offset: int, n: int) -> bytes:
        lo = offset - self.start
        if lo < 0 or lo + n > len(self.window):
            self.file.seek(offset)
            self.start, self.window = offset, self.file.read(max(n, BLOCK))
            lo = 0
        return self.window[lo : lo + n]


class _Gzip:
    """The bytes of a gzip member, piece by piece; `end` is its end once it has passed whole."""

    def __init__(self, data: _Bytes, at: int) -> None:
        self.data, self.at, self.end = data, at, None

    def __iter__(self):
        z, here = zlib.decompressobj(31), self.at
        while not z.eof:
            piece = z.unconsumed_tail
            if not piece:
                piece = self.data.at(here, min(1 << 16, self.data.size - here)) if here < self.data.size else b""
                here += len(piece)
            if not piece:
                return
            try:
                got = z.decompress(piece, BLOCK)
            except zlib.error:
                return
            if got:
                yield got
        self.end = here - len(z.unused_data)


class _Plain:
    """The bytes of an uncompressed record, which its length field ends."""

    def __init__(self, data: _Bytes, at: int) -> None:
        self.data, self.at, self.end = data, at, None
        n = 1 << 12
        while (mark := (head := data.at(at, min(n, data.size - at))).find(b"\r\n\r\n")) < 0 and at + n < data.size:
            n *= 2
        length = re.search(rb"(?i)\r\ncontent-length:[ \t]*(\d+)[ \t]*(?=\r\n)", head[: mark + 2]) if mark >= 0 else None
        end = at + mark + 4 + int(length[1]) + 4 if length else data.size + 1
        self.end = end if end <= data.size else None

    def __iter__(self):
        here = self.at
        while self.end and here < self.end:
            piece = self.data.at(here, min(BLOCK, self.end - here))
            yield piece
            here += len(piece)


@dataclass
class Payload:
    """What follows the head of a record's block; content: its bytes, if they were asked for."""

    size: int
    digest: str
    content: bytes | None


def _fields(head: bytes) -> dict | None:
    """Fields of a record's head; None if its version line or a field is wrong."""
    lines = head.split(b"\r\n")
    if not re.fullmatch(rb"WARC/1\.[01]", lines[0]):
        return None
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().decode("latin-1").lower()] = value.strip().decode("utf-8", "replace")
    return fields if fields.get("content-length", "").isdigit() else None


def parse_record(pieces, keep: bool = True) -> tuple[dict, Payload] | None:
    """Fields and payload of a whole record given in pieces; None if its version line, fields, length or digest are wrong."""
    fields, left, held, inner, size = None, 0, bytearray(), False, 0
    sha, content = hashlib.sha1(), bytearray()

    def take(part) -> None:
        nonlocal size
        sha.update(part)
        size += len(part)
        if keep:
            content.extend(part)

    for piece in pieces:
        held += piece
        if fields is None:
            if not held.startswith(b"WARC/1."[: len(held)]):
                return None
            mark = held.find(b"\r\n\r\n")
            if mark < 0:
                continue
            fields = _fields(bytes(held[:mark]))
            if fields is None:
                return None
            left = int(fields["content-length"])
            del held[: mark + 4]
        if not inner and left:
            mark = held.find(b"\r\n\r\n", 0, left)
            if mark < 0 and len(held) < left:
                # The head of the block is not through yet; what was searched is no part of the payload.
                gone = max(0, len(held) - 3)
                del held[:gone]
                left -= gone
                continue
            skip = mark + 4 if mark >= 0 else left
            del held[:skip]
            left, inner = left - skip, True
        part = held[:left]
        take(part)
        del held[: len(part)]
        left -= len(part)
        if not left and len(held) > 4:
            return None
    if fields is None or left or held != b"\r\n\r\n":
        return None
    payload, said = Payload(size, base64.b32encode(sha.digest()).decode(), bytes(content) if keep else None), fields.get("warc-payload-digest", "")
    if fields.get("warc-type") == "response" and said.startswith("sha1:") and said[5:] != payload.digest:
        return None
    return fields, payload


def _find(data: _Bytes, at: int) -> int:
    """The next place from `at` on that may begin a record; the file's end if there is none."""
    while at < data.size:
        piece = data.at(at, min(BLOCK, data.size - at))
        hits = [k for m in (MAGIC, b"WARC/1.") if (k := piece.find(m)) >= 0]
        if hits:
            return at + min(hits)
        if at + len(piece) >= data.size:
            break
        at += max(1, len(piece) - 8)
    return data.size


def salvage(file, keep: bool = True):
    """Yields (start, end, problem, fields, payload): records, with problem None, and quarantined gaps."""
    data, at, bad = _Bytes(file), 0, None
    while at < data.size:
        first = data.at(at, min(8, data.size - at))
        whole = _Gzip(data, at) if first.startswith(MAGIC) else _Plain(data, at) if first.startswith(b"WARC/1.") else None
        record = parse_record(whole, keep) if whole else None
        if record and whole.end:
            if bad is not None:
                yield bad, at, "no valid record", None, None
                bad = None
            yield at, whole.end, None, *record
            at = whole.end
        else:
            bad = at if bad is None else bad
            at = _find(data, at + 1)
    if bad is not None:
        yield bad, data.size, "no valid record", None, None


def _reader(keep_payload: bool):
    def run(batches):
        import pyarrow as pa
        from pyarrow import fs as pafs

        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        names = [x.split()[0] for x in RECORD.split(", ")]

        def number(x):
            return int(x) if x is not None and re.fullmatch(r"-?\d+", x) else None

        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, name = pafs.FileSystem.from_uri(path)
                rows, held = [], 0
                with fs.open_input_file(name) as file:
                    for start, end, problem, fields, payload in salvage(file, keep_payload):
                        if problem:
                            rows.append((path, start, end, problem, *[None] * 7))
                        else:
                            kind = fields.get("warc-type")
                            length = payload.size if kind == "response" else number(fields.get("x-payload-length"))
                            digest = payload.digest if kind == "response" else fields.get("warc-payload-digest", "").removeprefix("sha1:")
                            rows.append((path, start, end, None, kind, number(fields.get("x-page-id")), fields.get("warc-target-uri"), number(fields.get("x-refers-to-page-id")), length, digest, payload.content if kind == "response" else None))
                            held += len(payload.content or b"")
                        if len(rows) >= 4096 or held > 16 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return run


def read_warc(spark: SparkSession, folder: str, keep_payload: bool = True) -> DataFrame:
    """Records of all archives below folder and, with `problem` set, the gaps of bytes left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.warc*").load(folder)
    return read_archives(files.select("path"), keep_payload)


def read_archives(paths: DataFrame, keep_payload: bool = True) -> DataFrame:
    """As read_warc, for a table with a column of archive paths; an archive is read by one task, in blocks."""
    parts = max(1, min(10_000, paths.count()))
    return paths.select("path").repartition(parts, "path").mapInArrow(_reader(keep_payload), RECORD)


def op6_warc(pages: DataFrame) -> DataFrame:
    """Writes the pages to archives and returns what reading them back gives, a row a page."""
    folder = Scratch(pages.sparkSession, "warc").path("archives")
    log = write_warc(pages.select("page_id", "url", "html"), folder)
    if not log.limit(1).count():
        records = pages.sparkSession.createDataFrame([], RECORD)
    else:
        records = read_archives(log, keep_payload=False).filter("problem is null")
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP6_SQL = """
SELECT page_id, payload_bytes, payload_digest, record_type, refers_to FROM (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS hex,
         min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first,
         CASE WHEN page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
         CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to,
         (SELECT string_agg('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + (('0x' || hex[1 + 10 * (k // 8):10 + 10 * (k // 8)])::BIGINT >> (35 - 5 * (k % 8))) % 32], '' ORDER BY k)
          FROM range(32) t(k)) AS payload_digest
  FROM pages)
"""
