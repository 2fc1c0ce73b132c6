"""Mixing sources to target weights by a low-discrepancy schedule.

Every source is a stream: its documents in a fixed shuffled order, repeated. The stream is cut into
blocks of equally many words. Slots of the mix are points of a golden-ratio lattice mapped through
the cumulative shares of the sources; the slots of a source are ranked and slot r takes block r. So
any stretch of the mix holds every source near its share, and what a source gives is its target,
rounded to a word.

Targets: sources in code-point order (null last) weigh 5, 2, 1, repeating, and share ``factor``
times all words. A target stops at ``most`` times its source's size; the excess is reshared by
weight until none is above. No document is taken more than ``most`` times.

Defined cases: a null or empty text has size 0 and takes nothing; a null source is one more source;
without words all targets are 0; repeated rows are separate documents of the stream; an empty table
gives an empty result. Columns other than id, text and source are ignored, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlake.llm.common import boxed, pieces_for, ranked, running_total, staged, unboxed, word_count

WEIGHTS = (5, 2, 1)
FACTOR = 1.5
MOST = 2
BLOCK_WORDS = 4096
# Lattice of the golden ratio: point i is i * STEP mod LATTICE. LATTICE is prime.
LATTICE = 2**31 - 1
STEP = round(LATTICE * (math.sqrt(5) - 1) / 2)
# Among this many times the needed slots, every interval as wide as one block's share holds a point
# (consecutive points of a golden rotation leave no gap over 2.62 mean gaps).
SPARE = 3


def row_key(docs: DataFrame):
    """Two hashes of a whole row (but for columns that cannot be hashed)."""
    columns = [F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    nulls = [c.isNull() for c in columns]  # a null leaves a hash as it is, so nulls are hashed apart
    return [F.xxhash64(*columns, *nulls).alias("row_a"), F.xxhash64(F.lit("second"), *columns, *nulls).alias("row_b")]


def sized_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One narrow staged row per document: ``row``, ``doc_id``, ``source``, ``size``, the shuffle
    order and two hashes that name the whole row."""
    given = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.col(text_col).alias("text"), *row_key(docs)
    )
    sized = word_count(given, "text", "size")
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    narrow = sized.select(
        "doc_id",
        "source",
        "size",
        F.md5(name.cast("binary")).alias("shuffle"),
        "row_a",
        "row_b",
        F.monotonically_increasing_id().alias("row"),
    )
    return staged(narrow, "mix-sizes")


def targets(rows: DataFrame, weights=WEIGHTS, factor: float = FACTOR, most: int = MOST) -> DataFrame:
    """One staged row per source: ``source``, ``source_no``, ``source_size``, ``target``."""
    per_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = ranked(per_source, [F.col("source").asc_nulls_last()], "source_no", "mix-sources")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("source_no") % len(weights) + 1).cast("int"))
    ordered = ordered.withColumn("weight", weight).withColumn("cap", most * F.col("source_size"))
    level, capped = 0.0, -1
    while True:
        # Water level: what is left after the full sources, by weight over the others.
        full = F.col("weight") * F.lit(level) >= F.col("cap")
        if capped < 0:
            full = F.lit(False)
        got = ordered.agg(
            F.sum("source_size"), F.sum(F.when(full, F.col("cap"))), F.sum(F.when(~full, F.col("weight"))), F.count_if(full)
        ).first()
        if got[2] is None or got[3] == capped:
            break
        level, capped = (factor * (got[0] or 0) - (got[1] or 0)) / got[2], got[3]
    target = F.least(F.col("cap").cast("double"), F.col("weight") * F.lit(level))
    return staged(ordered.select("source", "source_no", "source_size", target.alias("target")), "mix-targets")


def _block_words(total: float, block_words: int) -> int:
    """Blocks grow where the schedule would otherwise outgrow the lattice."""
    return max(block_words, math.ceil(total * (SPARE + 1) / LATTICE))


def schedule(spark, sources: DataFrame, block: int) -> DataFrame:
    """Slots of the mix: ``slot``, ``source_no``, ``rank``; a source has a slot for every block."""
    needed = sources.withColumn("blocks", F.ceil(F.round("target") / block)).where("blocks > 0")
    ordered = running_total(
        needed.withColumn("_run", F.floor(F.col("source_no") / 1024)).withColumn("_all", F.lit(0)),
        ["_all"], "_run", ["source_no"], F.col("blocks"), "low",
    )
    total, count = needed.agg(F.coalesce(F.sum("blocks"), F.lit(0)), F.count(F.lit(1))).first()
    slots = SPARE * total + SPARE
    cells = max(1, 4 * count)
    width = max(1, total) / cells
    # A source's share is [low, low + blocks) of [0, total); both sides are dealt to equal cells.
    shares = ordered.select(
        "source_no", "blocks", "low",
        F.explode(F.sequence(F.floor(F.col("low") / width), F.floor((F.col("low") + F.col("blocks")) / width))).alias("cell"),
    )
    point = ((F.col("id") % LATTICE) * STEP % LATTICE + 0.5) / LATTICE * total
    points = spark.range(slots if total else 0).select(F.col("id").alias("slot"), point.alias("point"))
    placed = (
        points.withColumn("cell", F.floor(F.col("point") / width))
        .join(shares, "cell")
        .where((F.col("point") >= F.col("low")) & (F.col("point") < F.col("low") + F.col("blocks")))
        .withColumn("_run", F.floor(F.col("slot") / pieces_for(slots)))
    )
    rank = running_total(placed, ["source_no"], "_run", ["slot"], F.lit(1), "rank")
    return rank.where("rank < blocks").select("slot", "source_no", "rank")


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS, weights=WEIGHTS, factor: float = FACTOR, most: int = MOST, **columns):
    """The mix as (rows, pieces).

    ``rows``: one per document with ``source_size`` and ``target``. ``pieces``: what each slot takes
    of each document: ``slot``, ``row``, ``epoch``, ``word_start``, ``words``.
    """
    spark = docs.sparkSession
    rows = sized_rows(docs, **columns)
    sources = targets(rows, weights, factor, most)
    n, total = rows.count(), sources.agg(F.coalesce(F.sum("target"), F.lit(0.0))).first()[0]
    block = _block_words(total, block_words)
    known = rows.join(sources, rows["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    # The run of a document follows from its shuffle order, so runs have nearly equal sizes.
    run = F.floor(F.conv(F.substring("shuffle", 1, 8), 16, 10).cast("bigint") * pieces_for(n) / 2**32)
    streamed = running_total(
        known.withColumn("_run", run), ["source_no"], "_run", ["shuffle", "size", "row"], F.col("size"), "start"
    ).drop("_run")
    begin = F.col("start") + F.col("epoch") * F.col("source_size")
    parts = (
        streamed.where("size > 0")
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(most - 1))))
        .withColumn("from", begin)
        .withColumn("to", F.least(begin + F.col("size"), F.round("target").cast("bigint")))
        .where(F.col("from") < F.col("to"))
        .withColumn("rank", F.explode(F.sequence(F.floor(F.col("from") / block), F.floor((F.col("to") - 1) / block))))
    )
    low = F.greatest(F.col("from"), F.col("rank") * block)
    high = F.least(F.col("to"), (F.col("rank") + 1) * block)
    pieces = parts.join(schedule(spark, sources, block), ["source_no", "rank"]).select(
        "slot", "row", "epoch", (low - F.col("from")).alias("word_start"), (high - low).alias("words")
    )
    return known, pieces


def taken(docs: DataFrame, **settings) -> DataFrame:
    """Per document: ``doc_id``, ``size``, ``source_size``, ``target``, ``taken``."""
    rows, pieces = mix(docs, **settings)
    per_row = pieces.groupBy("row").agg(F.sum("words").alias("taken"))
    return rows.join(per_row, "row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken")
    )


def mixed_documents(docs: DataFrame, text_col: str = "text", **settings) -> DataFrame:
    """The mix as documents: all columns of ``docs``, one row per document and pass that takes it, in the order
    of the schedule: sorted by the first slot that takes words of the document in that pass.

    A document that the last block of its source takes in part is its text up to the end of its last
    word taken, with all white space as it was.
    """
    rows, pieces = mix(docs, text_col=text_col, **settings)
    passes = pieces.groupBy("row", "epoch").agg(F.sum("words").alias("_words"), F.min("slot").alias("_slot"))
    wanted = rows.join(passes, "row").select("row_a", "row_b", F.col("size").alias("_size"), "_words", "epoch", "_slot")
    # Equal rows are one row here; ``wanted`` has a row for each of them.
    keyed = docs.select(boxed(docs), F.col(f"`{text_col}`").alias("_text"), *row_key(docs)).dropDuplicates(["row_a", "row_b"])
    words = F.regexp_extract_all("_text", F.lit(r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+)"), 1)  # with the space before them
    cut = F.array_join(F.slice(words, F.lit(1), F.col("_words").cast("int")), "")
    text = F.when(F.col("_words") == F.col("_size"), F.col("_text")).otherwise(cut)
    order = ["_slot", "row_a", "row_b"]
    mixed = keyed.join(wanted, ["row_a", "row_b"]).select("_row", "_text", "_words", "_size", *order)
    placed = mixed.repartitionByRange(*order).sortWithinPartitions(*order)
    return placed.select(*unboxed(docs.columns, {text_col: text}))
