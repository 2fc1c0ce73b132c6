"""WARC archives with dictionary-compressed records (``.warc.zst``), written and read by tasks.

Each file starts with a skippable frame that holds a Zstandard dictionary trained on the file's own
first records (at most ``SAMPLE_BYTES`` of them), then one frame per record. A file with too little
to train on has no such frame. Files go to shared storage under names of their task attempt; the
staged manifest lists those of attempts that succeeded, so a retried task leaves no double records.

Of records with equal payloads of at least ``min_bytes`` bytes, that with the largest id is the
response and the others revisit it; smaller ones are all responses. Equality is that of length,
SHA-1 and a second 64-bit hash.

Defined cases: a null payload is empty; a null url leaves the target header out; rows that repeat
the largest id of their payload are all responses; a null id counts as the smallest, and a group
that only has null ids is all responses; an empty table gives no file and no row. Columns other than
id, url and payload are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlake.llm.common import fresh_dir, publish, shared_fs, staged

MIN_BYTES = 1000
DICTIONARY_MAGIC = 0x184D2A5D
DICTIONARY_BYTES = 64 << 10
SAMPLE_BYTES = 4 << 20
FILE_BYTES = 64 << 20
LEVEL = 6
DATE = "1970-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID = "urn:x-page:"
READ_BYTES = 1 << 20


def with_record_types(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = MIN_BYTES) -> DataFrame:
    """``page_id``, ``url``, ``payload``, ``refers_to``: the response's id on revisits, else null."""
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    given = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload")).withColumns(
        {"_sha": F.sha1("payload"), "_hash": F.xxhash64("payload"), "_bytes": F.octet_length("payload")}
    )
    keys = ["_sha", "_hash", "_bytes"]
    # Summed in each task first; only payloads that occur again are left to join.
    repeated = (
        given.where(F.col("_bytes") >= min_bytes)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"), F.max("page_id").alias("_response"))
        .where("_n > 1")
        .drop("_n")
    )
    is_revisit = F.col("_response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_response"))
    return given.join(repeated, keys, "left").select(
        "page_id", "url", "payload", F.when(is_revisit, F.col("_response")).alias("refers_to")
    )


def _record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *[f"{k}: {v}" for k, v in headers], f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def page_record(page_id, url: str | None, payload: bytes, refers_to) -> bytes:
    """A response record, or a revisit record that has the HTTP headers only."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = [
        ("WARC-Record-ID", f"<{ID}{'null' if page_id is None else page_id}>"),
        ("WARC-Date", DATE),
        *([] if url is None else [("WARC-Target-URI", quote(url, safe=":/?#[]@!$&'()*+,;=%~"))]),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if refers_to is None:
        return _record("response", headers, http + payload)
    headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{ID}{refers_to}>")]
    return _record("revisit", headers, http)


def _dictionary(samples: list[bytes]) -> bytes:
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too few or too small samples to train on
        return b""


def archive_bytes(records: Iterator[bytes]) -> Iterator[bytes]:
    """The bytes of one archive: the dictionary's frame, then a frame per record."""
    first, size = [], 0
    for record in records:
        first.append(record)
        size += len(record)
        if size >= SAMPLE_BYTES:
            break
    trained = _dictionary(first)
    if trained:
        yield struct.pack("<II", DICTIONARY_MAGIC, len(trained)) + trained
    compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(trained) if trained else None)
    for record in first:
        yield compressor.compress(record)
    first.clear()
    for record in records:
        yield compressor.compress(record)


def read_archive(stream) -> Iterator[bytes]:
    """The records of an archive, one by one, from a file object."""
    data = stream.read(8)
    trained = None
    if len(data) == 8 and struct.unpack("<II", data)[0] == DICTIONARY_MAGIC:
        trained = zstandard.ZstdCompressionDict(stream.read(struct.unpack("<II", data)[1]))
        data = b""
    decompressor = zstandard.ZstdDecompressor(dict_data=trained)
    while True:
        if not data:
            data = stream.read(READ_BYTES)
            if not data:
                return
        frame, parts = decompressor.decompressobj(), []
        while True:
            parts.append(frame.decompress(data))
            if frame.eof:
                data = frame.unused_data
                break
            data = stream.read(READ_BYTES)
            if not data:
                raise ValueError("archive ends within a record")
        yield b"".join(parts)


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case, the version line as ``version``) and block of a record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)} | {"version": version}
    return headers, rest[: int(headers["content-length"])]


def write_archives(typed: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record per row and return the staged manifest: ``file``, ``records``, ``bytes``."""

    def run(batches):
        context, files = TaskContext.get(), 0
        rows = (
            (page_id, url, payload, refers_to)
            for batch in batches
            for page_id, url, payload, refers_to in zip(
                batch.column(0).to_pylist(),
                batch.column(1).to_pylist(),
                batch.column(2).cast(pa.large_binary()).to_pylist(),
                batch.column(3).to_pylist(),
            )
        )
        row = next(rows, None)
        while row is not None:
            name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}-{files:05d}.warc.zst"
            count = 0

            def records():
                nonlocal row, count
                size = 0
                info = b"software: auditlake\r\nformat: WARC file version 1.1\r\n"
                yield _record("warcinfo", [("WARC-Record-ID", f"<urn:x-file:{name}>"), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")], info)
                while row is not None and size < file_bytes:
                    made = page_record(*row)
                    size += len(made)
                    count += 1
                    row = next(rows, None)
                    yield made

            written = publish(folder, name, archive_bytes(records()))
            files += 1
            yield pa.RecordBatch.from_pylist([{"file": name, "records": count, "bytes": written}])

    return staged(typed.select("page_id", "url", "payload", "refers_to").mapInArrow(run, "file string, records bigint, bytes bigint"), "warc-manifest")


def _page_id(value: str) -> int | None:
    name = value.removeprefix(f"<{ID}").removesuffix(">")
    return None if name == "null" else int(name)


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """Per page record of the listed files: ``page_id``, ``payload_bytes``, ``payload_digest``,
    ``record_type``, ``refers_to``, ``file``. A response whose payload does not have the digest
    in its header is an error."""

    def row(headers: dict[str, str], block: bytes, name: str) -> dict:
        http, _, payload = block.partition(b"\r\n\r\n")
        length = int(next(x for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")).split(b":")[1])
        stated = base64.b32decode(headers["warc-payload-digest"].removeprefix("sha1:")).hex()
        if headers["warc-type"] == "response":
            found = hashlib.sha1(payload).hexdigest()
            if found != stated or len(payload) != length:
                raise ValueError(f"damaged payload of {headers['warc-record-id']} in {name}")
        return {
            "page_id": _page_id(headers["warc-record-id"]),
            "payload_bytes": length,
            "payload_digest": stated,
            "record_type": headers["warc-type"],
            "refers_to": _page_id(headers["warc-refers-to"]) if headers["warc-type"] == "revisit" else None,
            "file": name,
        }

    schema = pa.schema(
        [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("file", pa.string())]
    )

    def run(batches):
        store, at = shared_fs(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows = []
                with store.open_input_stream(f"{at}/{name}", compression=None) as stream:
                    for record in read_archive(stream):
                        headers, block = parse_record(record)
                        if headers["warc-type"] in ("response", "revisit"):
                            rows.append(row(headers, block, name))
                        if len(rows) == 1000:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows = []
                yield pa.RecordBatch.from_pylist(rows, schema)

    files = max(1, manifest.count())
    return manifest.select("file").repartition(files).mapInArrow(
        run, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, file string"
    )


def archive(pages: DataFrame, folder: str | None = None, **settings) -> DataFrame:
    """Write the archives of all pages to a shared folder and read them back."""
    folder = folder or fresh_dir(pages.sparkSession, "warc")
    manifest = write_archives(with_record_types(pages, **settings), folder)
    return read_archives(manifest, folder)
