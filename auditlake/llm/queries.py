"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlake.llm import grace, hard_negatives, jaccard, langid, line_dedup, mixing, packing, periodic, quality, token_counts, token_files, vectors, warc
from auditlake.llm.common import WORD, table

Query = Callable[[SparkSession, str], DataFrame]
# Vocabulary files are parameters of the operators; these are the queries'.
WORD_TOKENIZER = "word_bpe_49k.json"
PIECE_TOKENIZER = "piece_bpe_32k.model"
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without lines that many sites and many texts share."""
    clean = line_dedup.line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), everywhere=True)
    return clean.select(
        "doc_id", "n_lines", "n_removed", F.length("text").cast("bigint").alias("clean_chars"), F.md5("text").alias("clean_md5")
    )


ORACLES["op1_line_dedup"] = r"""
WITH docs AS (
  SELECT doc_id, source, text, string_split(text, chr(10)) AS l, row_number() OVER () AS row_id FROM documents),
lines AS (
  SELECT row_id, source, text, raw, pos, trim(raw, chr(32) || chr(9) || chr(13) || chr(11) || chr(12)) AS line
  FROM (SELECT row_id, source, text, unnest(l) AS raw, unnest(range(len(l))) AS pos FROM docs)),
shared AS (
  SELECT line FROM lines WHERE line <> '' GROUP BY line HAVING count(DISTINCT source) >= 10 AND count(DISTINCT text) >= 10),
marked AS (
  SELECT l.*, s.line IS NOT NULL AS common FROM lines l LEFT JOIN shared s USING (line)),
left_over AS (
  SELECT row_id, count(*) AS n_lines, count(*) FILTER (common) AS n_common,
         coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (NOT common), '') AS kept_text
  FROM marked GROUP BY row_id),
clean AS (
  SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_common, 0) AS n_removed,
         CASE WHEN n_common > 0 THEN kept_text ELSE text END AS text
  FROM docs LEFT JOIN left_over USING (row_id))
SELECT doc_id, n_lines, n_removed, length(text)::BIGINT AS clean_chars, md5(text) AS clean_md5 FROM clean
"""


@query
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page archived and read back."""
    return warc.archive(table(spark, sf_dir, "pages")).drop("file")


ORACLES["op2_warc"] = """
WITH given AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
typed AS (
  SELECT *, CASE WHEN octet_length(payload) >= 1000 THEN max(page_id) OVER (PARTITION BY payload) END AS response FROM given)
SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS payload_digest,
       CASE WHEN response <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN response <> page_id THEN response END AS refers_to
FROM typed
"""


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    docs = table(spark, sf_dir, "documents")
    return token_counts.token_counts(docs, public_tokenizers.path(PIECE_TOKENIZER), limit=4096)


@query
def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.taken(table(spark, sf_dir, "documents")).withColumn("target", F.round("target", 6))


ORACLES["op4_source_mix"] = r"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, 2 * sum(size)::BIGINT AS cap,
         [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM docs GROUP BY source),
filled AS (
  SELECT *, row_number() OVER w AS k, sum(cap) OVER w - cap AS cap_before, sum(weight) OVER () - sum(weight) OVER w + weight AS weight_left
  FROM sources WINDOW w AS (ORDER BY cap / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
level AS (
  SELECT (1.5 * (SELECT sum(source_size) FROM sources) - cap_before) / weight_left AS water
  FROM filled WHERE water * weight <= cap ORDER BY k LIMIT 1),
targets AS (SELECT source, source_size, least(cap::DOUBLE, weight * water) AS target FROM sources, level),
placed AS (
  SELECT doc_id, size, source_size, target, round(target)::BIGINT AS words,
         sum(size) OVER (PARTITION BY t.source ORDER BY md5(doc_id::VARCHAR) ROWS UNBOUNDED PRECEDING) - size AS start
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, round(target, 6) AS target,
       (least(size, greatest(0, words - start)) + least(size, greatest(0, words - source_size - start)))::BIGINT AS taken
FROM placed
"""


@query
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of every document, written and read back."""
    docs = table(spark, sf_dir, "documents")
    manifest, folder = token_files.token_files(docs, public_tokenizers.path(WORD_TOKENIZER), end_id=2)
    return token_files.read_token_files(manifest, folder)


@query
def op6_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every embedding."""
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


ORACLES["op6_vector_dedup"] = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
reach AS (SELECT vec_id AS node, vec_id AS seen FROM embeddings UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.seen)
SELECT node AS vec_id, (SELECT count(*) FROM links WHERE a = node) AS n_links, min(seen) AS component_id, node = min(seen) AS kept
FROM reach GROUP BY node
"""


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of at most 2048 tokens."""
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, public_tokenizers.path(WORD_TOKENIZER), end_id=1, with_ids=False).drop("ids")


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from three quarters of the labelled ones."""
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.where(~langid.held_out()))
    return langid.predict(docs, model).select(
        "doc_id", langid.held_out().alias("held_out"), "lang_pred", "score"
    )


@query
def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of near-duplicate texts of every document."""
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


ORACLES["op9_jaccard_join"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, row_number() OVER () AS row_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT row_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT row_id, w, unnest(range(1, greatest(len(w) - 3, least(len(w), 1) + 1))) AS i FROM words)),
sizes AS (SELECT row_id, count(*) AS n FROM shingles GROUP BY row_id),
common AS (
  SELECT a.row_id AS a, b.row_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.row_id <> b.row_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common c JOIN sizes x ON x.row_id = a JOIN sizes y ON y.row_id = b WHERE 100 * c.n >= 80 * (x.n + y.n - c.n)),
reach AS (SELECT row_id AS node, row_id AS seen FROM words UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.seen)
SELECT d.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(o.doc_id) AS component_id
FROM reach JOIN words d ON d.row_id = node JOIN words o ON o.row_id = seen LEFT JOIN sizes z ON z.row_id = node
GROUP BY node, d.doc_id
"""


@query
def op10_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules of every document with the verdict on its host."""
    return quality.host_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", *quality.MEASURES, "base_failed", "kept", F.round("host_rate", 9).alias("host_rate")
    )


ORACLES["op10_host_rules"] = r"""
WITH words AS (
  SELECT doc_id, source, text, row_number() OVER () AS row_id,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
windows AS (
  SELECT row_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS gram
  FROM (SELECT row_id, w, unnest(range(1, len(w) - 1)) AS i FROM words)),
again AS (
  SELECT row_id, i FROM (SELECT row_id, i, count(*) OVER (PARTITION BY row_id, gram) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT row_id, count(DISTINCT i + k) AS n FROM again, (SELECT unnest([0, 1, 2]) AS k) GROUP BY row_id),
lines AS (
  SELECT row_id, count(*) - count(DISTINCT line) AS n
  FROM (SELECT row_id, unnest(string_split(text, chr(10))) AS line FROM words WHERE text IS NOT NULL)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY row_id),
base AS (
  SELECT doc_id, source, len(w) AS n_words,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]')) AS n_symbols,
         coalesce(l.n, 0) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
  FROM words LEFT JOIN lines l USING (row_id) LEFT JOIN covered c USING (row_id)),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base),
hosts AS (
  SELECT source, count(*) AS n, sum(base_failed::INT)::DOUBLE AS f, f / n AS rate
  FROM judged WHERE source IS NOT NULL GROUP BY source),
prior AS (
  SELECT avg(rate) AS m, var_pop(rate) AS v,
         CASE WHEN v > 0 AND v < m * (1 - m) THEN m * (1 - m) / v - 1 END AS s FROM hosts),
rates AS (
  SELECT source, coalesce((f + m * s) / (n + s), m) AS host_rate FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(host_rate > 0.5, FALSE) AS kept, round(host_rate, 9) AS host_rate
FROM judged LEFT JOIN rates USING (source)
"""


@query
def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row that stays for every document, equal without white space."""
    return grace.groups(table(spark, sf_dir, "documents")).drop("row_id")


ORACLES["op11_exact_dedup"] = r"""
WITH given AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
  FROM documents)
SELECT doc_id, first(doc_id) OVER (PARTITION BY body ORDER BY chars DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY body) AS group_size,
       row_number() OVER (PARTITION BY body ORDER BY chars DESC, doc_id) = 1 AS kept, sha256(body) AS text_sha256
FROM given
"""


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth embedding, below each of its five best positives."""
    given = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(given.withColumn("label", label), F.col("vec_id") % 50 == 0)


ORACLES["op12_hard_negatives"] = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM usable a JOIN usable b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id, id AS negative_id, positive_score, score AS negative_score,
       row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id)::INT AS rank
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT same
 AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""


def planted_periods(docs: DataFrame) -> DataFrame:
    """Every tenth document by the checksum of its id repeats a stretch of words from some word on."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = docs.select(
        "doc_id", "text", F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("w"), F.floor(h / 10).alias("g")
    )
    sized = words.withColumn("n", F.size("w").cast("bigint")).withColumn("n", F.when(F.col("n") > 0, F.col("n")))
    placed = sized.withColumn("a", F.col("g") % F.col("n"))
    placed = placed.withColumn("p", F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)) + 1)
    at = lambda j: (F.col("a") + j % F.col("p")).cast("int")
    cycle = F.transform(F.sequence(F.lit(0), F.col("n") - F.col("a") - 1), lambda j: F.get("w", at(j)))
    repeated = F.concat_ws(" ", F.concat(F.slice("w", 1, F.col("a").cast("int")), cycle))
    return placed.select("doc_id", F.when(F.col("n").isNotNull(), repeated).otherwise(F.col("text")).alias("text"))


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeated words of every document, and digests of them and of the words they leave."""
    found = periodic.periodic_runs(planted_periods(table(spark, sf_dir, "documents").select("doc_id", "text")))
    higher = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    line = lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))
    return found.withColumn("best", F.reduce("runs", none, lambda best, r: F.when(higher(best, r), r).otherwise(best))).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform("runs", lambda r: F.concat(line(r), F.lit("\n")))), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline."""
    return corpus_pipeline.run(spark, sf_dir)


if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
