"""The registered queries on the smallest tables, against SQL or plain Python."""

import os
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from compare import connect, differences
from tokenizers import Tokenizer

import corpus_pipeline
from auditlake.llm.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def session(spark):
    for key, value in {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.codegen.wholeStage": "true",
        "spark.sql.codegen.factoryMode": "FALLBACK",
    }.items():
        spark.conf.set(key, value)
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.codegen.wholeStage", "false")
    spark.conf.set("spark.sql.codegen.factoryMode", "NO_CODEGEN")


@pytest.fixture(scope="module")
def texts(session):
    rows = session.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "lang").collect()
    return {r["doc_id"]: r for r in rows}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(session, name):
    assert differences(QUERIES[name](session, SF_DIR), connect(SF_DIR), ORACLES[name]) == []


def test_every_operator_has_a_query():
    assert {int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")} == set(range(1, 14)) and "pipeline" in QUERIES
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "jaccard_join", "source_mix", "packing"]


def test_token_counts(session, texts):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    found = QUERIES["op3_token_counts"](session, SF_DIR).collect()
    assert len(found) == len(texts)
    for r in found:
        n = len(library.encode(texts[r["doc_id"]]["text"] or ""))
        assert (r["n_tokens"], r["over_limit"]) == (n, n > 4096)


def test_token_files(session, texts):
    library, at = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0
    found = {r["doc_id"]: r for r in QUERIES["op5_token_files"](session, SF_DIR).collect()}
    assert len(found) == len(texts)
    for doc_id in sorted(texts):
        ids = np.array([*library.encode(texts[doc_id]["text"] or "", add_special_tokens=False).ids, 2], "<u4")
        r = found[doc_id]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(ids))
        at += len(ids)


def test_packing_pads_little(session, texts):
    sequences = {}
    for r in QUERIES["op7_packing"](session, SF_DIR).collect():
        sequences[r["sequence_id"]] = sequences.get(r["sequence_id"], 0) + r["length"]
    padding = sum(2048 - n for n in sequences.values() if n & (n - 1))
    assert max(sequences.values()) <= 2048 and padding <= 0.01 * sum(sequences.values())


def test_languages_of_held_out_documents(session, texts):
    found = QUERIES["op8_language_id"](session, SF_DIR).collect()
    assert len(found) == len(texts)
    for r in found:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    judged = [r for r in found if r["held_out"] and texts[r["doc_id"]]["lang"] and r["lang_pred"] != "und"]
    right = sum(r["lang_pred"] == texts[r["doc_id"]]["lang"] for r in judged)
    assert len(judged) > 20 and right >= 0.95 * len(judged)


def test_jaccard_join(session, texts):
    from test_odd_documents import brute_components

    found = QUERIES["op9_jaccard_join"](session, SF_DIR).collect()
    want = brute_components([(i, r["text"]) for i, r in texts.items()])
    assert {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in found} == set(want) and len(found) == len(texts)


def test_the_pipeline_packs_documents_of_every_source(session, texts):
    found = QUERIES["pipeline"](session, SF_DIR).collect()
    assert {r["doc_id"] for r in found} <= set(texts) and len({r["doc_id"] for r in found}) > len(texts) / 2
