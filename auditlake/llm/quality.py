"""Host-level quality rules: document rules, failure rates by host, shrunken, joined back.

A document fails the base rules when it has too few words or when too many of its words lie in
repeated word windows. A host's failure rate is the posterior mean under a beta prior fitted to the
rates of all hosts; documents of hosts above ``max_host_rate`` are dropped with their host.

Defined cases: null or empty text has no words and fails; a null host is no host, so only the base
rules judge its documents; with one host, or hosts that all have one rate, the prior is a point and
every host has the mean rate; repeated rows count as often as they occur; an empty table gives an
empty result. Columns other than id, text and host are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlake.llm.common import Words, slices, staged, utf8

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_HOST_RATE = 0.5
WINDOW = 3
# A host's documents are dealt over so many keys, with a copy of its verdict for each.
SALTS = 32
SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _repeated_words(words: Words, rows: int) -> np.ndarray:
    """Words of each text that lie in a window of WINDOW words found twice or more in it."""
    hashes, at = words.windows(words.hashes, WINDOW)
    covered = np.zeros(len(words.row) + WINDOW, bool)
    if len(at):
        row = words.row[at]
        order = np.lexsort((hashes, row))
        equal = (hashes[order][1:] == hashes[order][:-1]) & (row[order][1:] == row[order][:-1])
        again = np.zeros(len(at), bool)
        again[order[1:][equal]] = True
        again[order[:-1][equal]] = True
        for k in range(WINDOW):
            covered[at[again] + k] = True
    return np.bincount(words.row, covered[: len(words.row)], minlength=rows).astype(np.int64)


def _duplicate_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def measure(column: pa.Array) -> dict[str, np.ndarray]:
    """The measures of each text of a string column."""
    data, offsets = utf8(column)
    parts = {name: [] for name in MEASURES}
    for begin, stop in slices(offsets):
        at = offsets[begin : stop + 1] - offsets[begin]
        piece = data[offsets[begin] : offsets[stop]]
        words, rows = Words(piece, at), stop - begin
        code_points = words.is_word & ((piece & 0xC0) != 0x80)
        raw = piece.tobytes()
        parts["n_words"].append(words.counts)
        for name, marks in (("word_chars", code_points), ("n_symbols", SYMBOLS[piece])):
            total = np.append(0, np.cumsum(marks, dtype=np.int64))
            parts[name].append(total[at[1:]] - total[at[:-1]])
        parts["n_dup_lines"].append(np.array([_duplicate_lines(raw[at[i] : at[i + 1]]) for i in range(rows)], np.int64))
        parts["n_repeat_words"].append(_repeated_words(words, rows))
    return {k: np.concatenate(v) if v else np.zeros(0, np.int64) for k, v in parts.items()}


def document_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    min_words: int = MIN_WORDS,
    max_repeat_percent: int = MAX_REPEAT_PERCENT,
) -> DataFrame:
    """Per document: id, host, the measures and ``base_failed``. Works on each row alone."""
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"), F.col(text_col).alias("text"))
    id_type = given.schema["doc_id"].dataType.simpleString()
    host_type = given.schema["host"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            found = measure(batch.column("text"))
            names = ["doc_id", "host", *MEASURES]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("host"), *[pa.array(found[m], pa.int64()) for m in MEASURES]], names
            )

    schema = f"doc_id {id_type}, host {host_type}, " + ", ".join(f"{m} bigint" for m in MEASURES)
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    return given.mapInArrow(run, schema).withColumn("base_failed", failed)


def host_rates(judged: DataFrame) -> DataFrame:
    """Per host: documents, failures, and the failure rate shrunk by the empirical beta prior.

    The prior has the mean and the variance of the hosts' rates; ``strength`` is the number of
    documents it weighs. Only one row per host is left after the partial sums of each task.
    """
    hosts = (
        judged.where(F.col("host").isNotNull())
        .groupBy("host")
        .agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("base_failed").cast("bigint")).alias("n_failed"))
        .withColumn("rate", F.col("n_failed") / F.col("n_docs"))
    )
    prior = hosts.agg(F.avg("rate").alias("mean"), F.var_pop("rate").alias("spread")).select(
        "mean",
        F.when(
            (F.col("spread") > 0) & (F.col("spread") < F.col("mean") * (1 - F.col("mean"))),
            F.col("mean") * (1 - F.col("mean")) / F.col("spread") - 1,
        ).alias("strength"),
    )
    # One row of two numbers: safe to broadcast whatever the data.
    shrunk = (F.col("n_failed") + F.col("mean") * F.col("strength")) / (F.col("n_docs") + F.col("strength"))
    return hosts.join(F.broadcast(prior)).select(
        "host", "n_docs", "n_failed", F.coalesce(shrunk, F.col("mean")).alias("host_rate")
    )


def host_rules(docs: DataFrame, max_host_rate: float = MAX_HOST_RATE, **rules) -> DataFrame:
    """Per document: id, host, measures, ``base_failed``, ``host_rate`` and ``kept``.

    Texts are read once: their measures are staged, then summed by host and joined with the hosts'
    verdicts. The join meets narrow rows only; a host's rows are dealt over SALTS keys, and rows without
    a host take no part in it.
    """
    judged = staged(document_rules(docs, **rules), "document-rules")
    verdicts = host_rates(judged).select("host", "host_rate")
    dealt = verdicts.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64("doc_id", *MEASURES), F.lit(SALTS)).cast("int")
    hosted = judged.where(F.col("host").isNotNull()).withColumn("_salt", salt)
    rated = hosted.join(dealt, ["host", "_salt"], "left").select(*judged.columns, "host_rate")
    homeless = judged.where(F.col("host").isNull()).withColumn("host_rate", F.lit(None).cast("double"))
    bad_host = F.coalesce(F.col("host_rate") > max_host_rate, F.lit(False))
    return rated.unionByName(homeless).withColumn("kept", ~F.col("base_failed") & ~bad_host)
