"""Helpers of the text operators: words of whole texts in numpy, shared files, global row order."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from auditlake.session import scratch_dir

WORD = r"[^\x20\x09-\x0D]+"
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_BYTE = np.random.default_rng(20240611).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIXERS = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
# Bytes of text worked on at once; one longer text is worked on alone.
SLICE_BYTES = 1 << 21


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit integers that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * _MIXERS[0]
    x = (x ^ (x >> np.uint64(27))) * _MIXERS[1]
    return x ^ (x >> np.uint64(31))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column as one array and the offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``most`` bytes each; together they cover every row."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        stop = int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1
        stop = min(max(stop, row + 1), rows)
        yield row, stop
        row = stop


class Words:
    """Words (runs of bytes other than ASCII white space) of several texts.

    ``starts``/``ends`` are byte positions, ``row`` the text of each word, ``first`` the place of
    each text's first word (one more entry at the end) and ``hashes`` a 64-bit hash of each word.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        word = ~_SPACE[data]
        opens = word.copy()
        opens[1:] &= ~word[:-1]
        heads = offsets[:-1][offsets[:-1] < offsets[1:]]
        opens[heads] = word[heads]
        closes = word.copy()
        closes[:-1] &= ~word[1:]
        tails = offsets[1:][offsets[:-1] < offsets[1:]] - 1
        closes[tails] = word[tails]
        self.data, self.offsets, self.is_word = data, offsets, word
        self.starts = np.flatnonzero(opens)
        self.ends = np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)
        self.row = np.repeat(np.arange(len(offsets) - 1), self.counts)

    @property
    def hashes(self) -> np.ndarray:
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        length = self.ends - self.starts
        bounds = np.append(self.starts, len(self.data))
        place = np.arange(bounds[0], len(self.data)) - np.repeat(self.starts, np.diff(bounds))
        powers = np.full(int(length.max()) + 1, _BASE)
        powers[0] = 1
        powers = np.multiply.accumulate(powers)
        body = self.data[bounds[0] :]
        inside = self.is_word[bounds[0] :]
        parts = np.zeros(len(body), np.uint64)
        parts[inside] = _BYTE[body[inside]] * powers[place[inside]]
        return mix(np.add.reduceat(parts, self.starts - bounds[0]) + length.astype(np.uint64))

    def windows(self, hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the runs of ``width`` words within a text, and the place of their first word."""
        n = len(hashes) - width + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        total = np.zeros(n, np.uint64)
        for k in range(width):
            total = (total + hashes[k : k + n]) * _BASE
        at = np.flatnonzero(self.row[:n] == self.row[width - 1 :])
        return mix(total[at]), at


def shared_fs(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder in shared storage (file, HDFS or an object store)."""
    return fs.FileSystem.from_uri(path)


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new folder under spark.checkpoint.dir that exists already."""
    path = scratch_dir(spark, label)
    store, at = shared_fs(path)
    store.create_dir(at, recursive=True)
    return path


def publish(folder: str, name: str, chunks) -> int:
    """Write a file under a private name and move it into place; a retried task writes it again."""
    store, at = shared_fs(folder)
    private = f"{at}/.{name}.{uuid.uuid4().hex}"
    size = 0
    with store.open_output_stream(private, compression=None) as out:
        for chunk in chunks:
            out.write(chunk)
            size += len(chunk)
    store.move(private, f"{at}/{name}")
    return size


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back; nothing is computed twice after this."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_key(id_col: str = "doc_id", text_col: str = "text") -> list[Column]:
    """Two 64-bit hashes that name a row by id and text, null-safe; equal rows share them."""
    parts = [
        F.coalesce(F.col(id_col).cast("string"), F.lit("\0null")),
        F.coalesce(F.col(text_col), F.lit("\0null")),
    ]
    return [F.xxhash64(*parts).alias("_key_a"), F.xxhash64(F.lit("second"), *parts).alias("_key_b")]


def prepare(spark: SparkSession) -> SparkSession:
    """Settings of the text operators: small Arrow batches, since texts are long."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(docs: DataFrame, text_col: str, name: str) -> DataFrame:
    """All columns and the number of words of each whole text; null has none.

    ``bytes.split`` cuts at exactly the six ASCII white-space bytes.
    """
    schema = StructType([*docs.schema.fields, StructField(name, LongType())])

    def run(batches):
        for batch in batches:
            texts = batch.column(text_col).cast(pa.large_binary())
            sizes = [len(t.split()) if t else 0 for t in texts.to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sizes, pa.int64())], [*batch.schema.names, name])

    return docs.mapInArrow(run, schema)


def running_total(df: DataFrame, group: list[str], piece: str, order: list[str], value: Column, name: str) -> DataFrame:
    """Add the sum of ``value`` over the earlier rows of each group, without a task per group.

    ``piece`` cuts a group into consecutive runs: it must grow with ``order``. Runs are summed apart,
    their totals are added up over one row per run, and joined back.
    """
    local = Window.partitionBy(*group, piece).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy(*group).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        df.groupBy(*group, piece)
        .agg(F.sum(value).alias("_total"))
        .select(*group, piece, F.coalesce(F.sum("_total").over(across), F.lit(0)).alias("_before"))
    )
    return (
        df.withColumn("_local", F.coalesce(F.sum(value).over(local), F.lit(0)))
        .join(totals, [*group, piece])
        .withColumn(name, F.col("_local") + F.col("_before"))
        .drop("_local", "_before")
    )


def pieces_for(rows: int) -> int:
    """Runs to cut ``rows`` rows into: as many runs as rows in a run."""
    return max(1, math.isqrt(rows))


def ranked(df: DataFrame, order: list[Column], name: str, label: str) -> DataFrame:
    """Add the place of each row in the given order, from 0; sorted by ranges, counted per range."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = (
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    kept = staged(ranges, label).withColumn("_range", F.shiftright("_id", 33))
    counts = kept.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))  # one row per partition
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    within = F.col("_id") - F.shiftleft(F.col("_range"), 33)
    return kept.join(bases, "_range").withColumn(name, F.col("_base") + within).drop("_base", "_id", "_range")


def boxed(df: DataFrame, name: str = "_row") -> Column:
    """All columns as one struct, so that helper columns cannot clash with theirs."""
    return F.struct(*[F.col(f"`{c}`").alias(c) for c in df.columns]).alias(name)


def unboxed(columns: list[str], replaced: dict[str, Column], name: str = "_row") -> list[Column]:
    """The columns of the struct again, some of them replaced; replacements with new names follow."""
    back = [replaced.get(c, F.col(name).getField(c)).alias(c) for c in columns]
    return back + [v.alias(k) for k, v in replaced.items() if k not in columns]
