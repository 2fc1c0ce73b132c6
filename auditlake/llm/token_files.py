"""Flat token files: unsigned ids end to end, 64-bit document offsets beside them, memory-mapped.

Documents are sorted by id into ranges. Each task encodes its range and writes ``<name>.bin`` (ids,
two bytes each where the vocabulary fits, else four) and a draft index with offsets from 0. The
manifest has one row per range; prefix sums of its token counts are the bases, and a second small
step writes ``<name>.idx`` with offsets over the whole corpus. Readers map the files.

Index layout, little-endian: 8 bytes of magic, u32 bytes per id, u32 zero, u64 documents, then
u64 offsets (one more than documents), i64 document ids, u8 flags (1: the id is null).

Defined cases: a null or empty text is its end id alone; null ids come first; rows with one id are
ordered by a hash of their text, equal rows stay side by side; an empty table writes no file.
Columns other than id and text are ignored, whatever their names.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from auditlake.llm.common import fresh_dir, publish, shared_fs, staged
from auditlake.llm.token_ids import encoder

MAGIC = b"TOKIDX\x01\x00"
HEADER = struct.Struct("<8sIIQ")


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Append ``end_id`` to every document of a concatenation."""
    return np.insert(ids, np.cumsum(counts), end_id), counts + 1


def index_bytes(width: int, offsets: np.ndarray, doc_ids: np.ndarray, nulls: np.ndarray) -> bytes:
    head = HEADER.pack(MAGIC, width, 0, len(doc_ids))
    return head + offsets.astype("<u8").tobytes() + doc_ids.astype("<i8").tobytes() + nulls.astype("u1").tobytes()


def parse_index(raw: bytes):
    """Bytes per id, offsets, document ids and null flags of an index."""
    magic, width, _, docs = HEADER.unpack_from(raw)
    if magic != MAGIC:
        raise ValueError("not a token index")
    at = HEADER.size
    offsets = np.frombuffer(raw, "<u8", docs + 1, at)
    doc_ids = np.frombuffer(raw, "<i8", docs, at + 8 * (docs + 1))
    return width, offsets, doc_ids, np.frombuffer(raw, "u1", docs, at + 8 * (2 * docs + 1))


def mapped(folder: str):
    """File system and path of a folder; a local or mounted one gives memory-mapped files."""
    store, at = shared_fs(folder)
    return (fs.LocalFileSystem(use_mmap=True) if isinstance(store, fs.LocalFileSystem) else store), at


def write_ranges(docs: DataFrame, folder: str, tokenizer: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """Encode and write; the staged manifest has ``range``, ``name``, ``docs``, ``tokens``."""
    given = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    place = F.monotonically_increasing_id()
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").alias("_hash"), place.alias("_place")]
    keyed = given.select("*", *order[1:])
    keys = [order[0], F.col("_hash"), F.col("_place")]
    ordered = keyed.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")

    def run(batches):
        context = TaskContext.get()
        name = f"range-{context.partitionId():06d}-{context.taskAttemptId()}"
        encode = encoder(tokenizer)
        width = 2 if max(encode.vocabulary_size, end_id + 1) <= 1 << 16 else 4
        lengths, doc_ids, nulls = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, bool)]

        def chunks():
            for batch in batches:
                ids, counts = with_end(*encode.encode(batch.column("text")), end_id)
                lengths.append(counts)
                doc_ids.append(batch.column("doc_id").fill_null(0).to_numpy())
                nulls.append(batch.column("doc_id").is_null().to_numpy(zero_copy_only=False))
                yield ids.astype(f"<u{width}").tobytes()

        first = next(batches, None)
        while first is not None and not first.num_rows:
            first = next(batches, None)
        if first is None:
            return
        rest = batches

        def with_first():
            yield first
            yield from rest

        batches = with_first()
        publish(folder, f"{name}.bin", chunks())
        offsets = np.append(0, np.cumsum(np.concatenate(lengths)))
        publish(folder, f"{name}.draft", [index_bytes(width, offsets, np.concatenate(doc_ids), np.concatenate(nulls))])
        yield pa.RecordBatch.from_pylist(
            [{"range": context.partitionId(), "name": name, "docs": len(offsets) - 1, "tokens": int(offsets[-1])}],
            pa.schema([("range", pa.int32()), ("name", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64())]),
        )

    return staged(ordered.mapInArrow(run, "range int, name string, docs bigint, tokens bigint"), "token-ranges")


def _each_file(manifest: DataFrame, columns: list[str], run, schema: str) -> DataFrame:
    """Run over the manifest's rows, about one a task."""
    files = max(1, manifest.count())
    return manifest.select(*columns).repartition(files).mapInArrow(run, schema)


def write_indexes(manifest: DataFrame, folder: str) -> DataFrame:
    """Add ``base`` to the manifest, the ids before each range, and write the final indexes."""
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row per task
    based = staged(
        manifest.withColumn("base", F.coalesce(F.sum("tokens").over(earlier), F.lit(0))), "token-bases"
    )

    def run(batches):
        store, at = mapped(folder)
        for batch in batches:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with store.open_input_file(f"{at}/{name}.draft") as file:
                    width, offsets, doc_ids, nulls = parse_index(file.read_buffer())
                publish(folder, f"{name}.idx", [index_bytes(width, offsets + np.uint64(base), doc_ids, nulls)])
            yield batch.select(["name"])

    written = staged(_each_file(based, ["name", "base"], run, "name string"), "token-indexes")
    return based.join(written, "name")


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """Per document, from the files: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``."""

    def run(batches):
        store, at = mapped(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with store.open_input_file(f"{at}/{name}.idx") as file:
                    width, offsets, doc_ids, nulls = parse_index(file.read_buffer())
                local = (offsets - offsets[0]).astype(np.int64)
                with store.open_input_file(f"{at}/{name}.bin") as file:
                    for begin in range(0, len(doc_ids), 1000):
                        stop = min(begin + 1000, len(doc_ids))
                        low = int(local[begin])
                        raw = file.read_at((int(local[stop]) - low) * width, low * width)
                        ids = np.frombuffer(raw, f"<u{width}").astype("<u4")
                        cuts = local[begin : stop + 1] - low
                        crcs = [zlib.crc32(ids[cuts[i] : cuts[i + 1]]) for i in range(stop - begin)]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(doc_ids[begin:stop], pa.int64(), mask=nulls[begin:stop].astype(bool)),
                                pa.array(offsets[begin:stop].astype(np.int64)),
                                pa.array(np.diff(cuts), pa.int64()),
                                pa.array(crcs, pa.int64()),
                            ],
                            ["doc_id", "start", "n_tokens", "ids_crc32"],
                        )

    return _each_file(manifest, ["name"], run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_files(
    docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, str]:
    """Write the token files of all documents; the manifest and the folder."""
    folder = folder or fresh_dir(docs.sparkSession, "tokens")
    return write_indexes(write_ranges(docs, folder, tokenizer, end_id, id_col, text_col), folder), folder
