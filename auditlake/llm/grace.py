"""Exact deduplication by Grace hash partitioning.

Two texts are equal when they are the same bytes without the six ASCII white-space characters. Equality
is always decided on complete contents, in an open-addressing table; hashes only choose slots and buckets.

1. Every task collapses what it reads in a table of bounded size, so a group of copies leaves a task as one
   record for each table filled, with its number of rows and the best of them.
2. Records of contents that many tasks hold are merged in salted cells of ``FAN`` records, round by round.
3. All records are dealt to buckets by their digest. A task takes a bucket into its table; what does not fit
   is written out and dealt again by another hash, level after level, until no record is left over.

Records that go on are Parquet files in the shared folder, written through Spark's committer: a lost
executor repeats tasks, not results. Members (row, record) never travel with the contents.

Defined cases: a null text is the empty one, and all rows without a visible character are one group; a null
id comes after all others; of equal rows (same text, same id) one is kept; an empty table gives no rows;
columns other than those named are ignored by ``groups`` and kept by ``deduplicated``.
"""

from __future__ import annotations

import hashlib
from array import array
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlake.llm.common import boxed, staged, unboxed

SPACES = b" \t\n\x0b\x0c\r"
# Bytes of contents and entries that a table holds; a single longer content still fits an empty one.
TABLE_BYTES = 32 << 20
ENTRY_BYTES = 400
# Records of one content that may meet in a bucket; more are merged in salted cells first.
FAN = 64
BATCH_BYTES = 8 << 20


class Table:
    """Contents by open addressing with linear probing. An entry has a number, in order of arrival."""

    def __init__(self, hash_bits: int = 64):
        self.cut = (1 << hash_bits) - 1
        self.clear()

    def clear(self):
        self.slots, self.mask = array("l", [-1]) * 1024, 1023
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.used = 0

    def place(self, digest: bytes, content: bytes) -> tuple[int, int, int]:
        """Number of the entry with this content (-1 if none), its hash, and the slot where the search ended."""
        number = int.from_bytes(digest[:8], "little") & self.cut
        at, slots, mask = number & self.mask, self.slots, self.mask
        while (entry := slots[at]) >= 0:
            if self.hashes[entry] == number and self.contents[entry] == content:
                return entry, number, at
            at = (at + 1) & mask
        return -1, number, at

    def add(self, number: int, at: int, content: bytes) -> int:
        entry = len(self.hashes)
        self.slots[at] = entry
        self.hashes.append(number)
        self.contents.append(content)
        self.used += len(content) + ENTRY_BYTES
        if 2 * len(self.hashes) > self.mask:
            self._grow()
        return entry

    def _grow(self):
        self.mask = 2 * self.mask + 1
        self.slots = array("l", [-1]) * (self.mask + 1)
        for entry, number in enumerate(self.hashes):
            at = number & self.mask
            while self.slots[at] >= 0:
                at = (at + 1) & self.mask
            self.slots[at] = entry


def _preferred(best: tuple) -> tuple:
    """Sorts (characters, id, row): most characters, then least id (null last), then least row."""
    chars, key, row = best
    return (-chars, key is None, key if key is not None else 0, row)


RECORD = ["gid", "leader", "digest", "content", "n", "best_chars", "best_id", "best_row"]


def _record_types(kind: pa.DataType) -> list[pa.DataType]:
    return [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), kind, pa.int64()]


def _record_batches(rows, kind: pa.DataType, extra: list[tuple[str, pa.DataType]] = ()):
    """Arrow batches of bounded size from record tuples; the extra columns are null."""
    held, size = [], 0

    def batch():
        columns = [pa.array(c, t) for c, t in zip(zip(*held), _record_types(kind))]
        nulls = [pa.nulls(len(held), t) for _, t in extra]
        return pa.RecordBatch.from_arrays(columns + nulls, RECORD + [n for n, _ in extra])

    for row in rows:
        held.append(row)
        size += len(row[3] or b"") + 100
        if size >= BATCH_BYTES:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def _collapsed(given: DataFrame, table_bytes: int, hash_bits: int) -> DataFrame:
    """One row per input row (its record) and one per record (its content and best row)."""
    kind = given.schema["id"].dataType.simpleString()
    schema = f"{_ddl(kind)}, row_id bigint, id {kind}, of bigint"

    def run(batches):
        base, rows, records = TaskContext.get().partitionId() << 33, 0, 0
        table, gids, counts, best, digests = Table(hash_bits), [], [], [], []
        id_type = pa.int64()

        def flush():
            rows_out = zip(gids, gids, digests, table.contents, counts, *zip(*best)) if best else ()
            yield from _record_batches(rows_out, id_type, [("row_id", pa.int64()), ("id", id_type), ("of", pa.int64())])

        for batch in batches:
            id_type = batch.schema.field("id").type
            texts = batch.column("text").cast(pa.large_binary())
            ids, chars, of = batch.column("id").to_pylist(), batch.column("chars").to_pylist(), []
            places = batch.column("row").to_pylist()
            if None in places:
                places = list(range(base + rows, base + rows + len(ids)))
            for i, key in enumerate(ids):
                content = (texts[i].as_py() or b"").translate(None, SPACES)
                digest = hashlib.sha256(content).digest()
                mine = (chars[i], key, places[i])
                entry, number, at = table.place(digest, content)
                if entry < 0:
                    if table.used + len(content) > table_bytes and gids:
                        yield from flush()
                        table.clear()
                        gids, counts, best, digests = [], [], [], []
                        entry, number, at = table.place(digest, content)
                    entry = table.add(number, at, content)
                    gids.append(base + records)
                    counts.append(0)
                    best.append(mine)
                    digests.append(digest)
                    records += 1
                elif _preferred(mine) < _preferred(best[entry]):
                    best[entry] = mine
                counts[entry] += 1
                of.append(gids[entry])
            members = [pa.nulls(len(ids), t) for t in _record_types(id_type)]
            members += [pa.array(places, pa.int64()), batch.column("id"), pa.array(of, pa.int64())]
            rows += len(ids)
            yield pa.RecordBatch.from_arrays(members, [*RECORD, "row_id", "id", "of"])
        yield from flush()

    return given.mapInArrow(run, schema)


def _ddl(kind: str) -> str:
    return (
        f"gid bigint, leader bigint, digest binary, content binary, n bigint, best_chars bigint, best_id {kind}, best_row bigint"
    )


def _merged(records: DataFrame, kind: str, table_bytes: int, hash_bits: int, keep_content: bool) -> DataFrame:
    """Each task's records by equal content: every record with its leader, leaders with the group's figures.

    Records that the table has no room for come back as they are, without a leader. All records of a content
    are in one task, so they are either all in the table or all left over.
    """

    def run(batches):
        table, full = Table(hash_bits), False
        leaders, counts, best, digests = [], [], [], []
        id_type = pa.int64()

        def judged(batch):
            nonlocal full
            contents = batch.column("content").cast(pa.large_binary())
            rest = [batch.column(c).to_pylist() for c in ("gid", "digest", "n", "best_chars", "best_id", "best_row")]
            for i, (gid, digest, n, *mine) in enumerate(zip(*rest)):
                content, mine = contents[i].as_py(), tuple(mine)
                entry, number, at = table.place(digest, content)
                if entry >= 0:
                    counts[entry] += n
                    if _preferred(mine) < _preferred(best[entry]):
                        best[entry] = mine
                    yield (gid, leaders[entry], None, None, None, None, None, None)
                elif full or (table.used + len(content) > table_bytes and leaders):
                    full = True
                    yield (gid, None, digest, content, n, *mine)
                else:
                    table.add(number, at, content)
                    leaders.append(gid)
                    counts.append(n)
                    best.append(mine)
                    digests.append(digest)

        for batch in batches:
            id_type = batch.schema.field("best_id").type
            yield from _record_batches(judged(batch), id_type)
        contents = table.contents if keep_content else [None] * len(leaders)
        rows = zip(leaders, leaders, digests, contents, counts, *zip(*best)) if best else ()
        yield from _record_batches(rows, id_type)

    return records.mapInArrow(run, _ddl(kind))


def _bytes(records: DataFrame) -> int:
    size = F.octet_length("content") + F.lit(ENTRY_BYTES)
    return records.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]


def groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    row_col: str | None = None,
    table_bytes: int = TABLE_BYTES,
    fan: int = FAN,
    hash_bits: int = 64,
) -> DataFrame:
    """One row per row: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``, ``row_id``.

    Of equal texts the row with the most characters, then the smallest id, is kept. ``row_col`` names a
    number that is different in every row; without it rows are numbered as they are read. ``hash_bits``
    cuts the hashes of the tables, for tests of the comparison.
    """
    if fan < 2:
        raise ValueError("a cell takes two records or more")
    spark = docs.sparkSession
    row = F.col(row_col).cast("bigint") if row_col else F.lit(None).cast("bigint")
    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), row.alias("row"))
    given = given.withColumn("chars", F.coalesce(F.length("text"), F.lit(0)).cast("bigint"))
    kind = given.schema["id"].dataType.simpleString()
    start = staged(_collapsed(given, table_bytes, hash_bits), "grace-start")
    members = start.where(F.col("row_id").isNotNull()).select("row_id", "id", "of")
    records = start.where(F.col("gid").isNotNull()).select(*RECORD)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    # Contents that many tasks hold meet in cells of about ``fan`` records, until a bucket can take them.
    salted = []
    while True:
        counts = records.groupBy("digest").agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > fan)
        counts = staged(counts, "grace-hot")
        if counts.isEmpty():
            break
        cell = F.pmod(F.xxhash64("gid", F.lit(len(salted))), F.ceil(F.col("copies") / F.lit(fan)))
        cells = records.join(counts, "digest").select(*RECORD, cell.alias("cell"))
        dealt = cells.repartition(buckets, "digest", "cell").drop("cell")
        merged = staged(_merged(dealt, kind, table_bytes, hash_bits, keep_content=True), "grace-cells")
        salted.append(merged.where(F.col("leader") != F.col("gid")).select("gid", "leader"))
        onward = merged.where(F.col("content").isNotNull()).select(*RECORD)
        records = records.join(counts, "digest", "left_anti").select(*RECORD).unionByName(onward)

    levels = []
    while size := _bytes(records):
        n = max(buckets, -(-size // max(table_bytes // 2, 1)))
        dealt = records.repartition(n, F.xxhash64(F.lit(len(levels)), F.col("digest")))
        merged = staged(_merged(dealt, kind, table_bytes, hash_bits, keep_content=False), "grace-level")
        levels.append(merged.where(F.col("leader").isNotNull()))
        records = merged.where(F.col("leader").isNull()).select(*RECORD)

    settled = reduce(DataFrame.unionByName, levels, spark.createDataFrame([], _ddl(kind)))
    figures = settled.where(F.col("digest").isNotNull()).select(
        F.col("leader").alias("root"), "digest", "n", "best_id", "best_row"
    )
    roots = settled.select("gid", F.col("leader").alias("root"))
    for links in reversed(salted):
        further = links.join(roots.withColumnRenamed("gid", "leader"), "leader").select("gid", "root")
        roots = roots.unionByName(further)
    verdicts = roots.join(figures, "root").select("gid", "digest", "n", "best_id", "best_row")
    return members.join(verdicts, F.col("of") == F.col("gid")).select(
        F.col("id").alias("doc_id"),
        F.col("best_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("row_id") == F.col("best_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "row_id",
    )


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **bounds) -> DataFrame:
    """The rows that stay, with all their columns."""
    rows = staged(docs.select(boxed(docs), F.monotonically_increasing_id().alias("_at")), "grace-rows")
    own = F.col("_row").getField
    named = rows.select(own(id_col).alias("id"), own(text_col).alias("text"), "_at")
    stay = groups(named, "id", "text", row_col="_at", **bounds).where("kept").select(F.col("row_id").alias("_stay"))
    return rows.join(stay, F.col("_at") == F.col("_stay"), "left_semi").select(*unboxed(docs.columns, {}))
