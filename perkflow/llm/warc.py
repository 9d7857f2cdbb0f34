"""Zstandard-compressed web archives: writer, and a reader that validates what it reads.

Layout of a `.warc.zst` file: a skippable frame with the dictionary, then one Zstandard frame per
record. The reader takes the dictionary from the leading frame (plain or itself compressed), decodes
frame by frame, and checks version line, required headers, declared length, the end of the record and
the payload digest. A frame or record that fails gives a row with `error` and no payload; what follows
a broken frame in the same file cannot be found and ends in that row.

Records of equal payloads of at least `LEAST_REVISIT` bytes are stored once: the smallest page_id is
the response, the others are revisits that name it.

Tasks write archives of at most about `ARCHIVE_BYTES` into the shared folder under names of their own
attempt. Only the manifest that Spark commits says which files count, so lost executors and repeated
tasks leave nothing wrong behind.

Defined results: null html is an empty payload; null urls are left out of the record and read back as
null; rows with null page_id never serve as the response of others and are revisits where a page with
an id has the payload; rows that repeat an id and its payload have the same type. Other columns are not
read.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from typing import Any, BinaryIO
from urllib.parse import quote
from uuid import uuid4

import pyarrow as pa
import zstandard as zstd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perkflow.llm.common import learned, slices
from perkflow.sources import files
from perkflow.sources.scratch import materialise, scratch_path

LEAST_REVISIT = 100
ARCHIVE_BYTES = 32 << 20
LEVEL = 3
DICTIONARY_BYTES = 32 << 10
SAMPLE_PAGES, SAMPLE_BYTES = 256, 32 << 10
DATE = "1970-01-01T00:00:00Z"

# Fixed values of the archive formats.
DICTIONARY_MAGIC = 0x184D2A5D
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1"
REQUIRED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# End of fixed values.

_ID = "urn:perkflow:page:"
RECORD = (
    "path string, position long, record_type string, page_id long, target_uri string, "
    "payload_bytes long, payload_digest string, refers_to long, payload binary, error string"
)


# --- records ---------------------------------------------------------------------------------------


def _headers(pairs: list[tuple[str, str | None]]) -> bytes:
    lines = [f"{name}: {value}" for name, value in pairs if value is not None]
    return "\r\n".join(lines).encode() + b"\r\n\r\n"


def record(
    page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
    is_revisit: bool, date: str = DATE,
) -> bytes:
    """One response or revisit record. A revisit keeps the HTTP headers and drops the payload."""
    http = b"HTTP/1.1 200 OK\r\n" + _headers(
        [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))]
    )
    block = http if is_revisit else http + payload
    head = _headers(
        [
            ("WARC-Type", "revisit" if is_revisit else "response"),
            ("WARC-Record-ID", f"<{_ID}{'' if page_id is None else page_id}>"),
            ("WARC-Date", date),
            # Anything but printable ASCII is percent-encoded, so a url cannot break the headers.
            ("WARC-Target-URI", None if url is None else quote(url, safe=_PRINTABLE)),
            ("WARC-Payload-Digest", f"sha256:{digest}"),
            ("WARC-Profile", PROFILE if is_revisit else None),
            ("WARC-Refers-To", f"<{_ID}{refers_to}>" if is_revisit else None),
            ("Content-Type", "application/http; msgtype=response"),
            ("Content-Length", str(len(block))),
        ]
    )
    return VERSION + b"\r\n" + head + block + b"\r\n\r\n"


_PRINTABLE = "".join(chr(c) for c in range(33, 127))


def _fields(text: bytes) -> dict[str, str]:
    out = {}
    for line in text.decode("utf-8").split("\r\n"):
        name, colon, value = line.partition(":")
        if not colon:
            raise ValueError(f"header without a colon: {line[:80]!r}")
        out[name.strip().lower()] = value.strip()
    return out


def _page(value: str | None) -> int | None:
    number = (value or "").removeprefix(f"<{_ID}").removesuffix(">")
    return int(number) if number.lstrip("-").isdigit() else None


def parse(data: bytes) -> dict[str, Any]:
    """Fields of one record; ValueError says what is wrong with it."""
    head, blank, rest = data.partition(b"\r\n\r\n")
    first, _, lines = head.partition(b"\r\n")
    if not blank or not first.startswith(b"WARC/1."):
        raise ValueError("no version line or no end of the headers")
    fields = _fields(lines)
    missing = [name for name in REQUIRED if name.lower() not in fields]
    if missing:
        raise ValueError(f"missing headers: {', '.join(missing)}")
    if not fields["content-length"].isdigit():
        raise ValueError("Content-Length is no number")
    length = int(fields["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"record of {len(rest)} bytes, {length} and an empty line declared")
    out: dict[str, Any] = {
        "record_type": fields["warc-type"],
        "page_id": _page(fields["warc-record-id"]),
        "target_uri": fields.get("warc-target-uri"),
        "refers_to": _page(fields.get("warc-refers-to")),
    }
    if out["record_type"] not in ("response", "revisit"):
        return out
    http, blank, payload = rest[:length].partition(b"\r\n\r\n")
    if not blank or not http.startswith(b"HTTP/"):
        raise ValueError("no HTTP headers")
    size = _fields(http.partition(b"\r\n")[2]).get("content-length", "")
    if not size.isdigit():
        raise ValueError("HTTP Content-Length is no number")
    kind, _, digest = fields.get("warc-payload-digest", "").partition(":")
    if kind != "sha256":
        raise ValueError("no SHA-256 payload digest")
    if out["record_type"] == "revisit" and payload:
        raise ValueError("a revisit with a payload")
    if out["record_type"] == "response":
        if len(payload) != int(size):
            raise ValueError(f"payload of {len(payload)} bytes, {size} declared")
        if hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError("payload does not have the declared digest")
        out["payload"] = payload
    return out | {"payload_bytes": int(size), "payload_digest": digest}


# --- files -----------------------------------------------------------------------------------------


def dictionary_frame(dictionary: bytes) -> bytes:
    return struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary


def read_dictionary(stream: BinaryIO) -> tuple[bytes, bytes]:
    """The dictionary of the leading frame, empty without one, and the bytes read beyond it."""
    start = stream.read(8)
    if len(start) < 8 or struct.unpack("<I", start[:4])[0] != DICTIONARY_MAGIC:
        return b"", start
    size = struct.unpack("<I", start[4:])[0]
    dictionary = stream.read(size)
    if len(dictionary) != size:
        raise ValueError("the dictionary frame is cut off")
    if dictionary.startswith(ZSTD_MAGIC):
        dictionary = zstd.ZstdDecompressor().decompressobj().decompress(dictionary)
    return dictionary, b""


def frames(stream: BinaryIO) -> Iterator[tuple[int, bytes]]:
    """(number, content) of each frame after the dictionary, one in memory at a time."""
    dictionary, rest = read_dictionary(stream)
    used = zstd.ZstdCompressionDict(dictionary) if dictionary else None
    reader = zstd.ZstdDecompressor(dict_data=used)
    number = 0
    while rest or (rest := stream.read(1 << 20)):
        decoder, parts = reader.decompressobj(), []
        while True:
            parts.append(decoder.decompress(rest))
            if decoder.eof:
                rest = decoder.unused_data
                break
            rest = stream.read(1 << 20)
            if not rest:
                raise ValueError("the last frame is cut off")
        yield number, b"".join(parts)
        number += 1


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder (with its scheme) that every executor reaches."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def _trained(rows: list[dict[str, Any]]) -> bytes:
    """Dictionary from samples, empty if they are too few to train on."""
    samples = [row["html"].encode() for row in sorted(rows, key=lambda row: row["html"])]
    try:
        return zstd.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstd.ZstdError, ValueError):
        return b""


def train_dictionary(pages: DataFrame) -> bytes:
    """From a bounded sample: SAMPLE_PAGES different pages of at most SAMPLE_BYTES, by digest.

    The digests are chosen first, then their pages are read, and one task trains on them; the driver gets
    the dictionary only, however many tasks there are. Empty if the sample is too small to train on.
    """
    rows = pages.filter(F.octet_length("html").between(1, SAMPLE_BYTES)).select("html", F.md5("html").alias("_md5"))
    chosen = rows.select("_md5").distinct().orderBy("_md5").limit(SAMPLE_PAGES)
    few = F.broadcast(materialise(chosen, "sample_digests"))  # at most SAMPLE_PAGES
    return learned(rows.join(few, "_md5").select("html").distinct(), _trained)


def with_types(pages: DataFrame) -> DataFrame:
    """page_id, url, html, digest, refers_to and is_revisit.

    Only ids, digests and lengths move to find the copies; pages move once, by id.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long"), "url", "html", F.sha2(payload, 256).alias("digest"))
    large = rows.filter(F.octet_length("html") >= LEAST_REVISIT).select("page_id", "digest")
    first = large.groupBy("digest").agg(
        F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")
    )
    first = first.filter("n > 1 and refers_to is not null").drop("n")
    known = large.join(first, "digest").filter(
        F.col("page_id").isNull() | (F.col("page_id") > F.col("refers_to"))
    )
    named = known.filter(F.col("page_id").isNotNull()).distinct()
    out = rows.filter(F.col("page_id").isNotNull()).join(named, ["page_id", "digest"], "left")
    unnamed = known.filter(F.col("page_id").isNull()).select("digest", "refers_to").distinct()
    rest = rows.filter(F.col("page_id").isNull()).join(unnamed, "digest", "left")
    out = out.unionByName(rest.select(out.columns))
    return out.withColumn("is_revisit", F.col("refers_to").isNotNull())


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write every page as a record; the manifest (path, records, bytes) of the files that count."""
    dictionary, folder = train_dictionary(pages), files.qualified(pages.sparkSession, folder)
    typed = with_types(pages).select("page_id", "url", "html", "digest", "refers_to", "is_revisit")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _store(folder)
        store.create_dir(path, recursive=True)
        used = zstd.ZstdCompressionDict(dictionary) if dictionary else None
        press = zstd.ZstdCompressor(level=LEVEL, dict_data=used)
        task, attempt, number = TaskContext.get().partitionId(), uuid4().hex, 0
        out, name, size, records = None, "", 0, 0

        def closed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([records]), pa.array([size])],
                names=["path", "records", "bytes"],
            )

        for batch in slices(batches, 256):
            for row in batch.to_pylist():
                if out is None:
                    name = f"{path}/{task:05d}-{number:04d}-{attempt}.warc.zst"
                    out, number, records = store.open_output_stream(name, compression=None), number + 1, 0
                    lead = dictionary_frame(dictionary) if dictionary else b""
                    info = _headers(
                        [
                            ("WARC-Type", "warcinfo"),
                            ("WARC-Record-ID", f"<urn:uuid:{uuid4()}>"),
                            ("WARC-Date", DATE),
                            ("WARC-Filename", name.rpartition("/")[2]),
                            ("Content-Type", "application/warc-fields"),
                            ("Content-Length", "0"),
                        ]
                    )
                    lead += press.compress(VERSION + b"\r\n" + info + b"\r\n\r\n")
                    size = out.write(lead)
                payload = (row["html"] or "").encode()
                data = record(
                    row["page_id"], row["url"], payload, row["digest"], row["refers_to"], row["is_revisit"]
                )
                size += out.write(press.compress(data))
                records += 1
                if size >= ARCHIVE_BYTES:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    return materialise(typed.mapInArrow(run, "path string, records long, bytes long"), "manifest")


def read_archives(manifest: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records of the archives in `manifest` (path), read in the tasks; see RECORD.

    `payloads=False` checks the payloads but does not return them.
    """
    folder = files.qualified(manifest.sparkSession, folder)
    names = [field.split()[0] for field in RECORD.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string()]
    shape = pa.schema(list(zip(names, [*kinds, pa.int64(), pa.binary(), pa.string()])))

    def rows(store: fs.FileSystem, path: str) -> Iterator[dict[str, Any]]:
        number = -1
        try:
            with store.open_input_stream(path, compression=None) as stream:
                for number, data in frames(stream):
                    row = {"path": path, "position": number}
                    try:
                        row |= parse(data)
                    except ValueError as error:
                        row["error"] = str(error)
                    if not payloads:
                        row.pop("payload", None)
                    yield row
        except (zstd.ZstdError, ValueError) as error:
            yield {"path": path, "position": number + 1, "error": str(error)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = _store(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                held: list[dict[str, Any]] = []
                for row in rows(store, path):
                    held.append(row)
                    if len(held) >= 256:
                        yield pa.RecordBatch.from_pylist(held, schema=shape)
                        held = []
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=shape)

    return manifest.select("path").repartition("path").mapInArrow(run, RECORD)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages to archives in the shared folder and read the page records back."""
    folder = scratch_path(pages.sparkSession, "warc")
    found = read_archives(write_archives(pages, folder), folder, payloads=False)
    # A record that cannot be read must not vanish: it fails the job with its reason.
    checked = found.withColumn(
        "record_type", F.when(F.col("error").isNull(), F.col("record_type")).otherwise(F.raise_error("error"))
    )
    return checked.filter(F.col("record_type").isin("response", "revisit")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
