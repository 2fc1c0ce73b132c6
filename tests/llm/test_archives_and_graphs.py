"""Archives, vectors, components and the transducer."""

import hashlib
import io
import random
import struct
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

from auditlake.llm import hnsw, vectors, warc
from auditlake.llm.common import ranked, running_total
from auditlake.llm.components import components
from auditlake.llm.token_counts import CHUNK, Transducer

PAGES = "page_id BIGINT, url STRING, html STRING, payload STRING, _sha STRING"


def page_rows():
    big, other = "<p>é</p>" * 200, "y" * 1000
    rows = [(i, f"http://h{i}.example/a b?q={i}", f"<html>{i}</html>" * 70) for i in range(40)]
    rows += [(100, "http://x", big), (101, None, big), (102, "http://x\r\nEvil: 1", big), (103, "u", other), (99, "u", other)]
    rows += [(110, "u", "short"), (111, "u", "short"), (112, "u", None), (113, "u", "")]
    rows += [(120, "u", "z" * 1500), (120, "u", "z" * 1500), (119, "u", "z" * 1500), (None, "u", "z" * 1500), (None, "u", "n" * 2000), (None, "u", "n" * 2000)]
    rows += [(130, "u", "y" * 999), (131, "u", "y" * 999), (140, "u", "\r\n\r\nWARC/1.1\r\n" * 100)]
    return [(*r, "clash", "clash") for r in rows]


def want_of(rows):
    def payload(r):
        return (r[2] or "").encode()

    out = Counter()
    for r in rows:
        own = payload(r)
        same = [x[0] for x in rows if payload(x) == own and x[0] is not None]
        top = max(same) if same and len(own) >= 1000 and sum(payload(x) == own for x in rows) > 1 else None
        revisit = top is not None and r[0] != top
        out[(r[0], len(own), hashlib.sha1(own).hexdigest(), "revisit" if revisit else "response", top if revisit else None)] += 1
    return out


def test_archives_give_back_every_page(spark):
    rows = page_rows()
    found = warc.archive(spark.createDataFrame(rows, PAGES).repartition(3))
    assert Counter(tuple(r)[:5] for r in found.collect()) == want_of(rows)


def test_an_empty_table_gives_no_archive(spark):
    assert warc.archive(spark.createDataFrame([], PAGES)).collect() == []


def test_small_files_roll_over(spark, tmp_path):
    folder = str(tmp_path)
    typed = warc.with_record_types(spark.createDataFrame(page_rows(), PAGES).repartition(1))
    manifest = warc.write_archives(typed, folder, file_bytes=5000)
    assert manifest.count() > 3
    assert warc.read_archives(manifest, folder).count() == len(page_rows())


def test_the_dictionary_leads_the_file_and_records_stand_alone():
    records = [warc.page_record(i, f"http://a/{i}", f"<html><body>page {i} {'text ' * (i % 50)}</body></html>".encode(), None) for i in range(900)]
    raw = b"".join(warc.archive_bytes(iter(records)))
    magic, size = struct.unpack_from("<II", raw)
    assert magic == warc.DICTIONARY_MAGIC and 0 < size <= warc.DICTIONARY_BYTES
    assert list(warc.read_archive(io.BytesIO(raw))) == records
    # One frame a record.
    assert raw.count(b"\x28\xb5\x2f\xfd") >= len(records)
    headers, block = warc.parse_record(records[5])
    assert headers["warc-type"] == "response" and block.endswith(b"</html>")
    with pytest.raises(ValueError, match="ends within"):
        list(warc.read_archive(io.BytesIO(raw[:-5])))


def test_few_records_need_no_dictionary():
    records = [b"WARC/1.1\r\nContent-Length: 0\r\n\r\n\r\n\r\n"]
    raw = b"".join(warc.archive_bytes(iter(records)))
    assert list(warc.read_archive(io.BytesIO(raw))) == records


def unit(rng, n, dim):
    x = rng.normal(size=(n, dim))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_the_graph_finds_near_neighbours():
    rng = np.random.default_rng(0)
    x = unit(rng, 3000, 24).astype(np.float32)
    layers = hnsw.build(x)
    again = hnsw.unpack_layers(hnsw.pack_layers(layers), len(x))
    assert all((a == b).all() for a, b in zip(layers, again)) and len(layers) > 1
    ids, _ = hnsw.search(x, again, x[:200], 64)
    true = np.argsort(-(x[:200] @ x.T), axis=1)[:, :10]
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(ids, true)]) > 0.95


def vector_rows():
    rng = np.random.default_rng(4)
    rows, n = [], 0
    for label in (0, 1):
        for x in unit(rng, 60, 12):
            rows.append((n, x.tolist(), label))
            n += 1
        for family in range(2):  # dense groups of near copies, one larger than a beam
            centre = unit(rng, 1, 12)[0]
            for _ in range(70 if family else 5):
                rows.append((n, (centre + rng.normal(size=12) * 0.03).tolist(), label))
                n += 1
        chain = np.eye(12)[0]
        for k in range(8):  # links in a row: neighbours are near, ends are not
            rows.append((n, (np.cos(0.3 * k) * np.eye(12)[0] + np.sin(0.3 * k) * np.eye(12)[1]).tolist(), label))
            n += 1
        rows += [(n + i, chain.tolist(), label) for i in range(4)]  # exact copies
        n += 4
    one = [1.0] + [0.0] * 11
    odd = [None, [], [0.0] * 12, [float("nan")] * 12, [float("inf"), *one[1:]], [None, *one[1:]], [1.0, 0.0]]
    rows += [(n + i, v, 0) for i, v in enumerate(odd)]
    rows += [(n + 20, one, None), (n + 21, [2.0 * x for x in one], 0), (None, one, 0), (n + 22, one, 0), (n + 22, one, 0), (n + 23, [1e200, *one[1:]], 1)]
    return rows


def brute_vectors(rows):
    def usable(r):
        v = r[1]
        return r[0] is not None and r[2] is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    units = [np.array(r[1]) / max(map(abs, r[1])) if usable(r) else None for r in rows]
    units = [u / np.linalg.norm(u) if u is not None else None for u in units]
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(units):
        for j, b in enumerate(units):
            if i != j and a is not None and b is not None and rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b >= 0.93:
                links[i] += 1
                root[find(i)] = find(j)
    out = Counter()
    for i, r in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i)]
        least = r[0] if units[i] is None else min(ids)
        out[(r[0], links[i], least, r[0] == least)] += 1
    return out


@pytest.mark.parametrize("shard_rows", [16384, 60])
def test_vector_links_equal_brute_force(spark, shard_rows):
    rows = vector_rows()
    df = spark.createDataFrame([(*r, "clash") for r in rows], "vec_id BIGINT, embedding ARRAY<DOUBLE>, label INT, rep STRING")
    found = vectors.near_duplicates(df, shard_rows=shard_rows)
    assert Counter(tuple(r) for r in found.select("vec_id", "n_links", "component_id", "kept").collect()) == brute_vectors(rows)


def test_no_vectors_no_rows(spark):
    df = spark.createDataFrame([], "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT")
    assert vectors.near_duplicates(df).collect() == []


def test_components_of_random_graphs(spark):
    rng = random.Random(9)
    links = [(rng.randrange(120), rng.randrange(120)) for _ in range(70)] + [(200 + i, 201 + i) for i in range(25)] + [(300, 300 + i) for i in range(30)]
    root = {x: x for pair in links for x in pair}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    want = {(x, find(x)) for x in root if find(x) != x}
    found = components(spark.createDataFrame(links, "a BIGINT, b BIGINT")).collect()
    assert {(r["node"], r["component"]) for r in found} == want and len(found) == len(want)


def test_running_totals_and_ranks(spark):
    rng = random.Random(2)
    rows = [(rng.choice("aab"), i, rng.randrange(10)) for i in range(300)]
    df = spark.createDataFrame(rows, "g STRING, i BIGINT, n BIGINT").withColumn("run", F.floor(F.col("i") / 17))
    found = running_total(df, ["g"], "run", ["i"], F.col("n"), "before").collect()
    assert all(r["before"] == sum(n for g, i, n in rows if g == r["g"] and i < r["i"]) for r in found) and len(found) == 300
    places = ranked(df, [F.col("i").desc()], "place", "t").collect()
    assert all(r["place"] == 299 - r["i"] for r in places)


@pytest.fixture(scope="module")
def machine():
    return Transducer(public_tokenizers.path("piece_bpe_32k.model"))


def test_the_transducer_counts_as_the_library_does(machine):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rng = random.Random(1)
    pieces = sorted(machine.vocabulary.score)
    texts = ["", " ", "  a", "a  b   c    d", "<s>hi</s> <0x0A>\n", "日本語 テスト", "▁▁ x▁y", " \n \t\n  ", "😀😀 x", "\x00a", "1234567890", " trailing ", "x" * 3 * CHUNK, "aaaa" * CHUNK]
    texts += ["".join(rng.choice("ab theEé \n.,▁日1 re  ing") for _ in range(rng.randrange(1, 2 * CHUNK))) for _ in range(60)]
    texts += ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 300))).replace("▁", " ") for _ in range(60)]
    assert machine.count(pa.array([*texts, None])).tolist() == [*map(len, library.encode(texts)), 0]


def test_state_maps_compose(machine):
    """Running two stretches one after the other is running both at once, from any state."""
    rng = random.Random(7)
    text = np.frombuffer("".join(rng.choice("the reading of ab ▁") for _ in range(400)).encode("utf-32-le"), np.uint32)
    columns = machine.columns_of(machine.classes(text))
    for _ in range(20):
        i, j, k = sorted(rng.sample(range(401), 3))
        state = np.array([rng.randrange(len(machine.states))], np.int32)
        once, apart = np.zeros(400, np.int8), np.zeros(400, np.int8)
        whole = machine.run(columns, np.array([i]), np.array([k]), state, once)
        first = machine.run(columns, np.array([i]), np.array([j]), state, apart)
        second = machine.run(columns, np.array([j]), np.array([k]), first, apart)
        assert whole == second and (once == apart).all()
