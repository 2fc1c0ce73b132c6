"""Every document operator on nulls, empty and long texts, repeated rows, clashing columns, no rows."""

import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from auditlake.llm import jaccard, langid, line_dedup, mixing, packing, quality, token_counts, token_files
from auditlake.llm.token_ids import encoder

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
WORD_FILE = public_tokenizers.path("word_bpe_49k.json")
PIECE_FILE = public_tokenizers.path("piece_bpe_32k.model")


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def counted(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


def lowered(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


def shingle_set(text):
    w = WORDS.findall(lowered(text))
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute_components(rows):
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc_id)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [x for x in groups[find(i)] if x is not None]
        out.append((doc_id, len(sets[i]), min(ids) if ids else None))
    return Counter(out)


@pytest.mark.parametrize("frequent", [2, 64])
def test_jaccard_equals_brute_force(odd, frequent):
    found = jaccard.near_duplicates(odd, frequent=frequent)
    assert counted(found, "doc_id", "n_shingles", "component_id") == brute_components(rows_of(odd))


def test_jaccard_on_families_of_near_copies(spark):
    """Groups of copies with growing distance, under every class of frequent tokens."""
    rng = np.random.default_rng(3)
    rows, n = [], 0
    passage = [f"p{i}" for i in range(60)]
    for family in range(4):
        base = [f"f{family}w{rng.integers(0, 400)}" for _ in range(110)] + passage * (family % 2)
        for _ in range(14):
            words = list(base)
            for at in rng.integers(0, len(words), rng.integers(0, 7)):
                words[at] = f"n{rng.integers(0, 10**6)}"
            rows.append((n, " ".join(words)))
            n += 1
    rows += [(n + i, " ".join([f"u{i}x{k}" for k in range(90)] + passage)) for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    want = brute_components(rows)
    for frequent in (2, 8):
        assert counted(jaccard.near_duplicates(docs, frequent=frequent), "doc_id", "n_shingles", "component_id") == want


def test_one_of_each_group_stays(odd):
    kept = jaccard.one_per_group(odd)
    assert kept.columns == odd.columns
    rows = [(r["doc_id"], r["text"]) for r in kept.collect()]
    ids = [i for i, t in rows if WORDS.search(t or "")]
    assert len(ids) == len(set(ids)) and {3, 8} <= set(ids) and not {4, 5, 6, 9} & set(ids)
    assert sum(not WORDS.search(t or "") for _, t in rows) == sum(not WORDS.search(t or "") for _, t in rows_of(odd))


def brute_measures(text):
    words = WORDS.findall(text or "")
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORDS.search(x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered),
    )


def test_quality_measures_and_verdicts(odd):
    found = quality.host_rules(odd).collect()
    want = Counter((r["doc_id"], *brute_measures(r["text"])) for r in odd.collect())
    assert Counter((r["doc_id"], *[r[m] for m in quality.MEASURES]) for r in found) == want
    for r in found:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        host_fails = r["host"] is not None and r["host_rate"] > quality.MAX_HOST_RATE
        assert r["kept"] == (not r["base_failed"] and not host_fails)


def test_a_bad_host_takes_its_good_documents_along(spark):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(i, good if i % 10 else "short", f"h{i % 3}") for i in range(60)]
    rows += [(100 + i, "short" if i else good, "bad") for i in range(40)]
    found = quality.host_rules(spark.createDataFrame(rows, "doc_id BIGINT, text STRING, source STRING"))
    kept = {r["doc_id"]: r["kept"] for r in found.collect()}
    assert not kept[100] and all(kept[i] for i in range(60) if i % 10)
    rates = {r["host"]: r["host_rate"] for r in found.collect()}
    assert rates["bad"] < 39 / 40 and min(rates.values()) > 0.09


def test_hosts_of_one_rate_share_the_mean(spark):
    rows = [(1, "short", "a"), (2, "short", "b")]
    found = quality.host_rules(spark.createDataFrame(rows, "doc_id BIGINT, text STRING, source STRING")).collect()
    assert {r["host_rate"] for r in found} == {1.0}


def test_line_dedup_against_plain_python(spark):
    rng = np.random.default_rng(5)
    own = lambda k: [f"own line {k} {i} {rng.integers(0, 10**9)}" for i in range(6)]
    rows = []
    for k in range(60):
        lines = own(k)
        lines.insert(int(rng.integers(0, 6)), " Shared everywhere.\t")
        if k % 2:
            lines.insert(0, "Shared by half")
        rows.append((k, "\n".join(lines), None if k % 13 == 0 else f"s{k % 12}"))
    rows += [(100 + k, "Shared everywhere.\nx", f"s{k}") for k in range(3)] + [(200, None, "s1"), (201, "", "s1"), (0, rows[0][1], None)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, source STRING").withColumn("n_lines", F.lit("clash"))
    sites = {}
    for _, text, source in rows:
        for line in (text or "").split("\n"):
            sites.setdefault(line.strip(" \t"), set()).add(source)
    common = {x for x, s in sites.items() if x and len(s - {None}) >= 6}
    want = Counter()
    for doc_id, text, _ in rows:
        lines = (text or "").split("\n")
        left = [x for x in lines if x.strip(" \t") not in common]
        size = lambda xs: sum(len(x.strip(" \t")) for x in xs)
        cut = len(left) < len(lines) and 2 * size(left) >= size(lines)
        want[(doc_id, "\n".join(left) if cut else text, len(lines) if text is not None else 0, len(lines) - len(left) if cut else 0)] += 1
    found = line_dedup.line_dedup(docs, min_sites=6)
    assert set(found.columns) == {"doc_id", "text", "source", "n_lines", "n_removed"}
    assert counted(found, "doc_id", "text", "n_lines", "n_removed") == want
    assert any(k[3] == 2 for k in want) and any(k[0] == 100 and k[3] == 0 for k in want)


def test_line_dedup_passes_odd_documents(odd):
    found = line_dedup.line_dedup(odd)
    assert counted(found, "doc_id", "text") == counted(odd, "doc_id", "text")


def test_the_mix_meets_its_targets(spark, odd):
    found = mixing.taken(odd, block_words=50).collect()
    assert len(found) == odd.count()
    sizes = Counter((r["doc_id"], r["size"]) for r in found)
    assert sizes == Counter((i, len(WORDS.findall(t or ""))) for i, t in rows_of(odd))
    for r in found:
        assert 0 <= r["taken"] <= 2 * r["size"] and r["target"] <= 2 * r["source_size"]
    total = sum(r["size"] for r in found)
    assert abs(sum(r["taken"] for r in found) - 1.5 * total) <= 5
    again = mixing.taken(odd, block_words=50)
    assert counted(again, "doc_id", "taken") == Counter((r["doc_id"], r["taken"]) for r in found)


def test_every_stretch_of_the_mix_is_near_its_shares(spark):
    rows = [(i, "w " * 100, f"s{i % 3}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, source STRING")
    known, pieces = mixing.mix(docs, block_words=100)
    source = {r["row"]: r["source"] for r in known.collect()}
    slots = sorted((r["slot"], source[r["row"]]) for r in pieces.collect())
    order = [s for _, s in dict(slots).items()]
    share = Counter(order)
    for stop in range(40, len(order), 40):
        for s, n in Counter(order[:stop]).items():
            assert abs(n - stop * share[s] / len(order)) < 0.12 * len(order) + 4


def test_mixed_documents_hold_the_words_taken(odd):
    found = mixing.mixed_documents(odd)
    assert found.columns == odd.columns
    got = Counter()
    for i, t in rows_of(found):
        got[i] += len(WORDS.findall(t or ""))
    want = Counter()
    for r in mixing.taken(odd).collect():
        want[r["doc_id"]] += r["taken"]
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}


def test_language_of_odd_documents(odd):
    model = langid.train(odd)
    assert model.langs == ["en", "fr"]
    found = langid.labelled(odd, model)
    assert set(found.columns) == {*odd.columns, "score"}
    for r in found.collect():
        letters = any(map(str.isalpha, r["text"] or ""))
        assert (r["lang_pred"] == "und") == (not letters) and 0 <= r["score"] <= 1


def test_a_model_of_nothing_tells_nothing(odd, empty):
    found = langid.predict(odd, langid.train(empty)).collect()
    assert {(r["lang_pred"], r["score"]) for r in found} == {("und", 0.0)}


def test_slices_of_a_long_text_hold_each_gram_once(monkeypatch):
    text = "abcdefghij" * 30
    whole = np.sort(np.concatenate(list(langid.features(text, 4096))))
    monkeypatch.setattr(langid, "SLICE_CHARS", 7)
    assert (np.sort(np.concatenate(list(langid.features(text, 4096)))) == whole).all()


def test_token_counts_equal_the_library(odd):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_FILE)
    want = Counter((i, len((t or "").encode()), len(library.encode(t or "")), len(library.encode(t or "")) > 50) for i, t in rows_of(odd))
    found = token_counts.token_counts(odd, PIECE_FILE, limit=50)
    assert counted(found, "doc_id", "n_bytes", "n_tokens", "over_limit") == want


def ids_of(text, end):
    ids = Tokenizer.from_file(WORD_FILE).encode(text or "", add_special_tokens=False).ids
    return np.array([*ids, end], "<u4")


def test_token_files_hold_every_document(odd):
    manifest, folder = token_files.token_files(odd, WORD_FILE, end_id=2)
    found = token_files.read_token_files(manifest, folder).collect()
    want = Counter((i, len(x), zlib.crc32(x)) for i, x in ((i, ids_of(t, 2)) for i, t in rows_of(odd)))
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in found) == want
    at = 0
    for r in sorted(found, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    ids = [r["doc_id"] for r in sorted(found, key=lambda r: r["start"])]
    assert ids == sorted(ids, key=lambda x: (x is not None, x))


@pytest.mark.parametrize("limits", [packing.Limits(), packing.Limits(64, 3, 40)])
def test_packing_holds_every_id_once(odd, limits):
    docs = odd.withColumn("bearing", F.when(F.col("doc_id") % 2 == 0, F.lit(7)))
    found = packing.pack(docs, WORD_FILE, 1, limits, loss_col="bearing").collect()
    texts = {}
    for i, t in rows_of(odd):
        texts.setdefault(i, []).append(ids_of(t, 1))
    assert sum(r["length"] for r in found) == sum(len(x) for xs in texts.values() for x in xs)
    for r in found:
        piece = np.array(r["ids"], "<u4")
        assert r["ids_crc32"] == zlib.crc32(piece) and len(piece) == r["length"] > 0
        assert any(len(x) == r["doc_tokens"] and (x[r["start"] : r["start"] + r["length"]] == piece).all() for x in texts[r["doc_id"]])
    sequences = {}
    for r in sorted(found, key=lambda r: r["offset"]):
        sequences.setdefault(r["sequence_id"], []).append(r)
    for pieces in sequences.values():
        assert [p["offset"] for p in pieces] == [sum(q["length"] for q in pieces[:k]) for k in range(len(pieces))]
        assert sum(p["length"] for p in pieces) <= limits.tokens and len(pieces) <= limits.segments
        assert sum(p["loss_tokens"] for p in pieces) <= limits.loss


@pytest.mark.parametrize(
    "run",
    [
        lambda d: quality.host_rules(d),
        lambda d: line_dedup.line_dedup(d),
        lambda d: jaccard.near_duplicates(d),
        lambda d: jaccard.one_per_group(d),
        lambda d: mixing.taken(d),
        lambda d: mixing.mixed_documents(d),
        lambda d: langid.labelled(d, langid.train(d)),
        lambda d: token_counts.token_counts(d, PIECE_FILE, 10),
        lambda d: token_files.read_token_files(*token_files.token_files(d, WORD_FILE, 2)),
        lambda d: packing.pack(d, WORD_FILE, 1),
    ],
)
def test_an_empty_table_gives_an_empty_result(empty, run):
    assert run(empty).collect() == []


def test_the_pipeline_stages_pass_odd_documents(spark, odd):
    docs = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, "")
        assert after.columns == docs.columns, name
        docs = spark.createDataFrame(after.collect(), after.schema)
    found = corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()
    want = Counter()
    for i, t in rows_of(docs):
        want[i] += len(ids_of(t, 0))
    got = Counter()
    for r in found:
        got[r["doc_id"]] += r["length"]
    assert got == want and len(got) > 5


def test_word_encoder_equals_the_library_on_odd_strings():
    odd = ["", None, "a", "don't 'tis we'll", "x<|endoftext|>y", "Éa É, é", "a\x1cb\x85c\xa0d", "İ ΣΑΣ ß!", "a  b\t\nc", "(word).", "日本 語", "a.b,c!? .."]
    import pyarrow as pa

    ids, counts = encoder(WORD_FILE).encode(pa.array(odd))
    library, at = Tokenizer.from_file(WORD_FILE), 0
    for text, n in zip(odd, counts):
        assert list(ids[at : at + n]) == library.encode(text or "", add_special_tokens=False).ids
        at += n


def test_most_documents_without_a_host(spark):
    rows = [(i, "w " * (i % 3), None if i % 10 else "h") for i in range(300)] + [(None, None, None)] * 3
    found = quality.host_rules(spark.createDataFrame(rows, "doc_id BIGINT, text STRING, source STRING")).collect()
    assert counted(found_rows := spark.createDataFrame([(r["doc_id"],) for r in found], "doc_id BIGINT"), "doc_id") == Counter((r[0],) for r in rows)
    assert {(r["host"], r["host_rate"], r["kept"]) for r in found} == {(None, None, False), ("h", 1.0, False)} and found_rows.count() == 303
