"""WARC archives compressed with Zstandard: writer, and reader with checks.

An archive starts with a skippable frame that holds the dictionary of its
records (itself compressed or not); then every record is one frame. The writer
fills archives inside the tasks that hold the pages, trains each archive's
dictionary on its first records (at most ``sample_records`` and
``sample_bytes``) and starts a new archive at ``archive_bytes``. Payloads seen
more than once are written once, as the response with the largest page id; the
others become revisit records that name it and carry only the HTTP header. The
reader takes whole archives from Spark's binary file source, decodes frame by
frame, and raises on anything that does not fit: a frame without exactly one
record, missing headers, wrong lengths, a payload unlike its digest.

Files lie under a folder every executor reaches. Each task attempt writes names
of its own and only the names that finished tasks report are read, so repeated
attempts and lost executors do no harm.

Which page a payload belongs to is settled on narrow rows (digest, page id):
partial maxima per digest before the shuffle, and only digests that occur twice
are joined back, so a payload shared by a third of all pages is one row.

Edge cases: a NULL page is the empty payload; a NULL url has no target header;
NULL page ids sort before all others; rows that repeat the largest page id with
its payload are all responses; an empty table gives no archives and no rows;
further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.llm.common import stored
from punctual.session import scratch_folder

# Fixed values of the format.
DICTIONARY_MAGIC = (0x184D2A5D).to_bytes(4, "little")
FRAME_MAGIC = (0xFD2FB528).to_bytes(4, "little")
VERSION = b"WARC/1.1"
SAME_PAYLOAD = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = (b"warc-type", b"warc-record-id", b"warc-date", b"content-length")
ID_PREFIX, ID_SUFFIX = b"<urn:x-page:", b">"


@dataclass(frozen=True)
class Archiving:
    archive_bytes: int = 64 << 20  # of records, before compression
    dictionary_bytes: int = 32 << 10
    sample_records: int = 200
    sample_bytes: int = 2 << 20
    level: int = 3
    min_payload: int = 0  # smaller payloads are never revisited
    date: str = "2024-01-01T00:00:00Z"


class ArchiveError(ValueError):
    """An archive that breaks the format."""


# ---- records -----------------------------------------------------------------


def digest_text(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _http(length: int) -> bytes:
    return (
        b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        b"Content-Length: %d\r\n\r\n" % length
    )


def record(
    page_id: int | None, url: str | None, payload: bytes, digest: str, head: int | None, date: str
) -> bytes:
    """One WARC record; ``head`` is the page a revisit refers to."""
    lines = [
        VERSION,
        b"WARC-Type: " + (b"response" if head is None else b"revisit"),
        b"WARC-Record-ID: %s%s%s" % (ID_PREFIX, str(page_id).encode(), ID_SUFFIX),
        b"WARC-Date: " + date.encode(),
        b"WARC-Payload-Digest: sha1:" + digest.encode(),
        b"Content-Type: application/http; msgtype=response",
    ]
    if url is not None:
        lines.append(b"WARC-Target-URI: " + quote(url, safe="!#$%&'()*+,/:;=?@[]~").encode())
    block = _http(len(payload))
    if head is None:
        block += payload
    else:
        lines += [
            b"WARC-Profile: " + SAME_PAYLOAD,
            b"WARC-Refers-To: %s%d%s" % (ID_PREFIX, head, ID_SUFFIX),
        ]
    lines.append(b"Content-Length: %d" % len(block))
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(lines: list[bytes]) -> dict[bytes, bytes]:
    found: dict[bytes, bytes] = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon:
            raise ArchiveError(f"not a header: {line[:80]!r}")
        found[name.strip().lower()] = value.strip()
    return found


def _number(value: bytes) -> int:
    if not value.isdigit():
        raise ArchiveError(f"not a length: {value[:40]!r}")
    return int(value)


def parse(raw: bytes) -> dict:
    """The fields of a record, checked."""
    head, blank, rest = raw.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not blank or not lines[0].startswith(b"WARC/"):
        raise ArchiveError("a frame must hold one record")
    headers = _headers(lines[1:])
    for name in REQUIRED:
        if name not in headers:
            raise ArchiveError(f"missing header {name.decode()}")
    length = _number(headers[b"content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ArchiveError("the block's length differs from its header")
    http, blank, payload = rest[:length].partition(b"\r\n\r\n")
    if not blank or not http.startswith(b"HTTP/"):
        raise ArchiveError("the block must be an HTTP response")
    size = _number(_headers(http.split(b"\r\n")[1:]).get(b"content-length", b""))
    kind = headers[b"warc-type"].decode()
    digest = headers.get(b"warc-payload-digest", b"").decode().removeprefix("sha1:")
    if kind == "response":
        if len(payload) != size or digest_text(payload) != digest:
            raise ArchiveError("the payload differs from its length or digest")
    elif kind == "revisit":
        if payload or b"warc-refers-to" not in headers:
            raise ArchiveError("a revisit refers to another record and has no payload")
    else:
        raise ArchiveError(f"unexpected record type {kind}")
    return {
        "record_id": headers[b"warc-record-id"].decode(),
        "record_type": kind,
        "url": headers[b"warc-target-uri"].decode() if b"warc-target-uri" in headers else None,
        "refers_to": headers[b"warc-refers-to"].decode() if kind == "revisit" else None,
        "payload_bytes": size,
        "payload_digest": digest,
        "payload": payload if kind == "response" else None,
    }


# ---- archives ------------------------------------------------------------------


def _dictionary(samples: list[bytes], size: int):
    """A dictionary trained on ``samples``; where they are too few or too alike,
    their own heads are one."""
    import zstandard

    try:
        if len(samples) >= 8:
            return zstandard.train_dictionary(size, samples, k=512, d=8)
    except zstandard.ZstdError:
        pass
    each = max(64, size // max(1, len(samples)))
    heads = b"".join(s[:each] for s in samples)[-size:]
    # shorter content than eight bytes is no dictionary
    return zstandard.ZstdCompressionDict(
        heads.ljust(8, b"\n"), dict_type=zstandard.DICT_TYPE_RAWCONTENT
    )


def archive(records: list[bytes], how: Archiving = Archiving()) -> bytes:
    """The bytes of one archive."""
    import zstandard

    samples, size = [], 0
    for r in records:
        # long records give way to the next ones, or to their own heads
        if len(samples) < how.sample_records and size + len(r) <= how.sample_bytes:
            samples.append(r)
            size += len(r)
    samples = samples or [r[: how.dictionary_bytes] for r in records[:1]]
    trained = _dictionary(samples, how.dictionary_bytes)
    packer = zstandard.ZstdCompressor(level=how.level, dict_data=trained)
    body = zstandard.ZstdCompressor(level=how.level).compress(trained.as_bytes())
    head = DICTIONARY_MAGIC + len(body).to_bytes(4, "little") + body
    return b"".join([head, *map(packer.compress, records)])


def frames(data: bytes) -> Iterator[bytes]:
    """Decoded frames of an archive, its own dictionary applied."""
    import zstandard

    view, at, words = memoryview(data), 0, None
    if data[:4] == DICTIONARY_MAGIC:
        size = int.from_bytes(data[4:8], "little")
        at = 8 + size
        if at > len(data):
            raise ArchiveError("the dictionary is cut off")
        body = bytes(view[8:at])
        if body[:4] == FRAME_MAGIC:
            body = zstandard.ZstdDecompressor().decompress(body, max_output_size=1 << 27)
        words = zstandard.ZstdCompressionDict(body)
    reader = zstandard.ZstdDecompressor(dict_data=words) if words else zstandard.ZstdDecompressor()
    while at < len(data):
        one, parts, step = reader.decompressobj(), [], 4096
        try:
            while not one.eof:
                if at >= len(data):
                    raise ArchiveError("the last frame is cut off")
                piece = view[at : at + step]
                parts.append(one.decompress(piece))
                at += len(piece) - (len(one.unused_data) if one.eof else 0)
                step = min(step * 4, 1 << 22)
        except zstandard.ZstdError as e:
            raise ArchiveError(f"not a frame: {e}") from e
        yield b"".join(parts)


# ---- on tables ------------------------------------------------------------------


def _qualified(spark: SparkSession, folder: str) -> str:
    """The folder's full URI, as tasks outside the JVM need it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    uri = files.makeQualified(path).toString()
    return "file://" + uri[5:] if uri.startswith("file:/") and uri[5:7] != "//" else uri


def settle(pages: DataFrame, min_payload: int = 0) -> DataFrame:
    """Pages with payload, digest and, for revisits, the page they refer to."""
    body = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    bodies = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), body.alias("payload")
    ).withColumn("digest", F.sha1("payload"))
    heads = (
        bodies.where(F.octet_length("payload") >= min_payload)
        .groupBy("digest")
        .agg(F.max("page_id").alias("head"), F.count("*").alias("n"))
        .where("n > 1")
        .select(F.col("digest").alias("of_digest"), "head")
    )
    heads = stored(heads, "warc-heads")
    other = ~F.col("page_id").eqNullSafe(F.col("head"))
    return bodies.join(heads, F.col("digest") == F.col("of_digest"), "left").select(
        "page_id", "url", "payload", "digest", F.when(other, F.col("head")).alias("refers_to")
    )


def write_archives(pages: DataFrame, folder: str, how: Archiving = Archiving()) -> DataFrame:
    """Write ``pages`` as archives below ``folder``; names and record counts."""
    target = _qualified(pages.sparkSession, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        files, base = fs.FileSystem.from_uri(target)
        files.create_dir(base, recursive=True)
        held: list[bytes] = []
        size = 0

        def flush() -> pa.RecordBatch:
            name = f"{uuid.uuid4().hex}.warc.zst"
            with files.open_output_stream(f"{base}/{name}", compression=None) as out:
                out.write(archive(held, how))
            done = pa.RecordBatch.from_pydict({"archive": [name], "records": [len(held)]})
            held.clear()
            return done

        for batch in batches:
            columns = [batch.column(n) for n in ("page_id", "url", "payload", "digest", "refers_to")]
            for page_id, url, payload, digest, head in zip(*columns):
                body = payload.as_py()
                text = base64.b32encode(bytes.fromhex(digest.as_py())).decode()
                held.append(
                    record(page_id.as_py(), url.as_py(), body, text, head.as_py(), how.date)
                )
                size += len(held[-1])
                if size >= how.archive_bytes:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    settled = settle(pages, how.min_payload)
    return stored(settled.mapInArrow(run, "archive string, records long"), "warc-names")


RECORD = (
    "record_id string, record_type string, url string, refers_to string,"
    " payload_bytes long, payload_digest string, payload binary"
)


def read_archives(
    spark: SparkSession, folder: str, names: DataFrame | None = None, payloads: bool = True
) -> DataFrame:
    """Records of the archives below ``folder``, or of those in ``names``.

    Every record is decoded and checked whole, also where ``payloads`` are not
    handed on.
    """
    if names is not None and not names.take(1):
        return spark.createDataFrame([], RECORD)
    found = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.warc.zst")
        .load(folder)
        .select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    )
    if names is not None:
        found = found.join(names.select("archive"), F.col("name") == F.col("archive"), "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("name"), batch.column("content")):
                rows, size = [], 0
                for raw in frames(content.as_py()):
                    try:
                        row = parse(raw)
                    except ArchiveError as e:
                        raise ArchiveError(f"{name.as_py()}: {e}") from e
                    if not payloads:
                        row["payload"] = None
                    rows.append(row)
                    size += len(row["payload"] or b"") + 200
                    if size > 16 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    return found.mapInArrow(run, RECORD)


_ARROW = pa.schema(
    [
        ("record_id", pa.string()),
        ("record_type", pa.string()),
        ("url", pa.string()),
        ("refers_to", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("payload", pa.binary()),
    ]
)


def page_number(identifier: Column) -> Column:
    """The page id of a record id; NULL where the page had none."""
    return F.regexp_extract(identifier, r"(-?\d+)>$", 1).try_cast("long")


def archived_pages(pages: DataFrame, how: Archiving = Archiving()) -> DataFrame:
    """Write the pages to archives, read them back, one row per page."""
    spark = pages.sparkSession
    folder = scratch_folder(spark, "warc")
    names = write_archives(pages, folder, how)
    return read_archives(spark, folder, names, payloads=False).select(
        page_number(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page_number(F.col("refers_to")).alias("refers_to"),
    )
