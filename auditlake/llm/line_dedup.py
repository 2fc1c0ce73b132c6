"""Removal of boilerplate lines by how many sites they are on. DataFrame functions only.

Lines are compared by two 64-bit hashes of the line without outer white space. Lines seen on one
site only are dropped from the count by the least and greatest site of each hash. The others get
HyperLogLog sketches of their sites, merged by aggregation; lines whose estimate is near the
threshold get an exact distinct count. Lines on ``min_sites`` sites or more are removed from their
documents.

There are two rules for copies of documents, which are for document deduplication to judge. By
default a document that would lose more than half of its characters is left whole, as in the SQL of
``op1_line_dedup``. With ``everywhere`` a line must also be in ``min_sites`` different texts, so exact
copies do not make boilerplate of their own lines, and boilerplate is removed from every document,
however much of it that is.

Defined cases: a null text stays null, with no lines; lines without a word are never boilerplate; a
null site counts as no site, but its documents lose boilerplate lines too; repeated lines count once per site; equal rows get equal results; an empty
table gives an empty result. Other columns are passed on, whatever their names; ``n_lines`` and
``n_removed`` replace columns of those names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlake.llm.common import boxed, staged, unboxed

MIN_SITES = 10
SKETCH_LG_K = 12
# Five standard errors of a sketch with 2^12 registers, and one site at least.
NEAR = 5 * 1.04 / 2 ** (SKETCH_LG_K / 2)
LINE = ["_line_a", "_line_b"]
ROW = ["_row_a", "_row_b"]
OUTER = " \t\r\x0b\x0c"


def _lines(text):
    return F.split(text, "\n", -1)


def _row_key():
    """Two hashes of site and text: rows that share both have the same lines and verdicts."""
    parts = [F.coalesce(F.col("_site"), F.lit("\0null")), F.coalesce(F.col("_text"), F.lit("\0null"))]
    return [F.xxhash64(*parts).alias(ROW[0]), F.xxhash64(F.lit("second"), *parts).alias(ROW[1])]


def occurrences(keyed: DataFrame, texts: bool = False) -> DataFrame:
    """Staged occurrences of the lines that are on two sites or more: row, position, line, site.

    With ``texts`` also a hash of the text, and only lines in two texts or more."""
    keys = [*ROW, "_site", "_text_a"] if texts else [*ROW, "_site"]
    exploded = keyed.withColumn("_text_a", F.xxhash64("_text")).select(
        *keys, F.posexplode(_lines(F.col("_text"))).alias("_at", "_raw")
    )
    line = F.btrim("_raw", F.lit(OUTER))
    hashed = exploded.withColumn("_line", line).where("_line <> ''").select(
        *keys, "_at",
        F.xxhash64("_line").alias(LINE[0]), F.xxhash64(F.lit("second"), "_line").alias(LINE[1]),
    )
    site = F.when(F.col("_site").isNotNull(), F.xxhash64("_site"))
    ends = [F.min(site).alias("_least"), F.max(site).alias("_most")]
    shared = F.col("_least") != F.col("_most")
    if texts:
        ends += [F.min("_text_a").alias("_first"), F.max("_text_a").alias("_last")]
        shared &= F.col("_first") != F.col("_last")
    spread = hashed.groupBy(*LINE).agg(*ends).where(shared)
    return staged(hashed.join(spread, LINE, "left_semi"), "line-occurrences")


def boilerplate(found: DataFrame, min_sites: int = MIN_SITES, counted: str = "_site") -> DataFrame:
    """Hashes of the lines on ``min_sites`` sites or more, or in so many of another column."""
    sketched = staged(
        found.groupBy(*LINE)
        .agg(F.hll_sketch_agg(counted, SKETCH_LG_K).alias("_sketch"))
        .select(*LINE, F.hll_sketch_estimate("_sketch").alias("_sites")),
        "line-sites",
    )
    band = max(1.0, NEAR * min_sites)
    sure = sketched.where(F.col("_sites") > min_sites + band).select(*LINE)
    near = sketched.where(F.col("_sites").between(min_sites - band, min_sites + band)).select(*LINE)
    exact = (
        found.join(near, LINE, "left_semi")
        .groupBy(*LINE)
        .agg(F.count_distinct(counted).alias("_exact"))
        .where(F.col("_exact") >= min_sites)
        .select(*LINE)
    )
    return sure.unionByName(exact)


def line_dedup(
    docs: DataFrame,
    text_col: str = "text",
    site_col: str = "source",
    min_sites: int = MIN_SITES,
    everywhere: bool = False,
) -> DataFrame:
    """The documents with boilerplate lines removed, ``n_lines`` and ``n_removed``."""
    given = docs.select(boxed(docs), F.col(f"`{text_col}`").alias("_text"), F.col(f"`{site_col}`").cast("string").alias("_site"))
    keyed = given.select("_row", "_text", *_row_key())
    found = occurrences(given.select("_text", "_site", *_row_key()), texts=everywhere)
    common = boilerplate(found, min_sites)
    if everywhere:
        common = common.join(boilerplate(found, min_sites, "_text_a"), LINE, "left_semi")
    places = (
        found.join(common, LINE)
        .groupBy(*ROW)
        .agg(F.collect_set("_at").alias("_places"))  # at most the lines of one document
    )
    lines = _lines(F.col("_text"))
    joined = keyed.join(places, ROW, "left").withColumn("_lines", lines).withColumn(
        "_left", F.filter("_lines", lambda line, i: ~F.array_contains("_places", i))
    )

    def chars(name):
        return F.aggregate(name, F.lit(0).cast("bigint"), lambda n, line: n + F.length(F.btrim(line, F.lit(OUTER))))

    # Only documents with such lines are measured.
    cut = F.col("_places").isNotNull()
    if not everywhere:
        cut &= F.when(F.col("_places").isNotNull(), 2 * chars("_left") >= chars("_lines"))
    removed = F.when(F.coalesce(cut, F.lit(False)), F.size("_places")).otherwise(0).cast("bigint")
    text = F.when(F.coalesce(cut, F.lit(False)), F.array_join("_left", "\n")).otherwise(F.col("_text"))
    n_lines = F.coalesce(F.size("_lines"), F.lit(0)).cast("bigint")
    n_lines = F.when(F.col("_text").isNull(), F.lit(0).cast("bigint")).otherwise(n_lines)
    return joined.select(*unboxed(docs.columns, {text_col: text, "n_lines": n_lines, "n_removed": removed}))
