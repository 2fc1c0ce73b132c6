"""Exact copies, hard negatives and periodic runs against brute force."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from conftest import CLASHING, SCHEMA
from pyspark.sql import functions as F

from auditlake.llm import grace, hard_negatives
from auditlake.llm.periodic import _of_texts, find_runs, periodic_runs
from auditlake.llm.queries import QUERIES
from auditlake.llm.repair import grammar

SPACES = re.compile(r"[\x20\x09-\x0D]")


# ---- Exact copies ------------------------------------------------------------------------------


def expected_groups(rows):
    """(doc_id, keep_id, group_size, sha) of every row, from (doc_id, text)."""
    found = {}
    for doc_id, text in rows:
        found.setdefault(SPACES.sub("", text or ""), []).append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    out = []
    for doc_id, text in rows:
        body = SPACES.sub("", text or "")
        out.append((doc_id, min(found[body])[3], len(found[body]), hashlib.sha256(body.encode()).hexdigest()))
    return sorted(out, key=str)


def seen_groups(frame):
    return sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in frame.collect()), key=str)


def test_copies_of_odd_documents(odd):
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    assert seen_groups(grace.groups(odd)) == expected_groups(rows)


@pytest.mark.parametrize("bounds", [{"table_bytes": 9000}, {"fan": 2}, {"hash_bits": 2, "table_bytes": 6000, "fan": 3}])
def test_copies_beyond_a_table_many_cells_and_equal_hashes(spark, bounds):
    rng = random.Random(5)
    bodies = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 9))) * rng.randrange(1, 60) for _ in range(60)]
    # A third of all rows are one text, in many tasks.
    rows = [(i, ("hot  text " * 20 + " " * (i % 3)) if i % 3 == 0 else " ".join(rng.choice(bodies))) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(8)
    found = grace.groups(docs, **bounds)
    assert seen_groups(found) == expected_groups(rows)
    kept = [r["doc_id"] for r in found.where("kept").collect()]
    assert sorted(kept) == sorted({k for _, k, _, _ in expected_groups(rows)})


def test_rows_that_stay_have_all_their_columns(odd):
    stay = grace.deduplicated(odd)
    assert stay.columns == odd.columns
    texts = [SPACES.sub("", r["text"] or "") for r in stay.collect()]
    assert len(texts) == len(set(texts)) == len({SPACES.sub("", r["text"] or "") for r in odd.collect()})
    # Equal rows, id and text alike: one stays.
    assert stay.where("doc_id = 3").count() == 1


def test_copies_of_nothing_and_of_a_long_text(spark, empty):
    assert grace.groups(empty).count() == 0 and grace.deduplicated(empty).columns == empty.columns
    long = "word and word\n" * 400_000
    docs = spark.createDataFrame([(2, long), (1, long + " "), (3, None)], "doc_id BIGINT, text STRING")
    assert {(r["doc_id"], r["keep_id"]) for r in grace.groups(docs, table_bytes=1 << 20).collect()} == {(2, 1), (1, 1), (3, 3)}


def test_table_compares_contents():
    table = grace.Table(hash_bits=1)
    numbers = {}
    for i in range(3000):
        content = str(i % 1500).encode()
        entry, number, at = table.place(hashlib.sha256(content).digest(), content)
        numbers.setdefault(content, table.add(number, at, content) if entry < 0 else entry)
        assert entry in (-1, numbers[content]) and (entry < 0) == (i < 1500)


# ---- Hard negatives ----------------------------------------------------------------------------


def expected_negatives(rows, anchors):
    """Brute force over (id, vector of integers, label)."""
    out = []
    for a, va, la in rows:
        if a not in anchors:
            continue
        others = [(sum(x * y for x, y in zip(va, v)), b, lb) for b, v, lb in rows if b != a and len(v) == len(va)]
        best = sorted((-s, b) for s, b, lb in others if lb == la)[:5]
        for s, p in best:
            low = sorted((-n, b) for n, b, lb in others if lb != la and 50 * -s <= 100 * n <= 95 * -s)[:3]
            out += [(a, p, i + 1, b, -s, -n) for i, (n, b) in enumerate(low)]
    return sorted(out)


def seen_negatives(frame):
    return sorted((r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"], r["positive_score"], r["negative_score"]) for r in frame.collect())


VECTORS = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT, rank STRING, shard STRING, id STRING, place STRING"


@pytest.mark.parametrize("shard_rows", [7, 40, 4096])
def test_negatives_of_tied_and_odd_vectors(spark, shard_rows):
    rng = random.Random(shard_rows)
    rows = []
    for i in range(150):
        vector = [rng.randrange(-3, 4) / 4 for _ in range(5)]
        rows.append((i, [1.0, 0.5, 0.0, -0.25, 0.5] if i % 3 == 0 else vector, rng.randrange(3)))
    rows += [(200, [0.0] * 5, 1), (201, [0.5, 0.25], 1), (202, [0.5, 0.5], 1), (203, [0.25, 0.5], 2), (204, [], 1), (205, [], 2)]
    kept = [(i, [int(np.floor(256 * x)) for x in v], label) for i, v, label in rows]
    odd = [(300, None, 1), (301, [None, 1.0, 1.0, 1.0, 1.0], 1), (302, [float("nan")] * 5, 0), (303, [float("inf")] * 5, 0), (304, [1.0] * 5, None), (None, [1.0] * 5, 1)]
    odd += [rows[3], rows[4]]
    frame = spark.createDataFrame([(*r, "x", "y", "z", "u") for r in rows + odd], VECTORS)
    found = hard_negatives.mine(frame, F.col("vec_id") % 4 == 0, shard_rows=shard_rows)
    assert seen_negatives(found) == expected_negatives(kept, {r[0] for r in rows if r[0] % 4 == 0})


def test_negatives_of_large_components_and_of_nothing(spark):
    rng = random.Random(1)
    rows = [(i, [float(rng.randrange(-(1 << 17), 1 << 17)) for _ in range(4)], i % 2) for i in range(40)]
    kept = [(i, [int(256 * x) for x in v], label) for i, v, label in rows]
    frame = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>, label INT")
    assert seen_negatives(hard_negatives.mine(frame, F.col("vec_id") < 9, shard_rows=16)) == expected_negatives(kept, set(range(9)))
    assert hard_negatives.mine(frame.limit(0), F.col("vec_id") < 9).count() == 0
    assert hard_negatives.mine(frame, F.lit(False)).count() == 0
    huge = spark.createDataFrame([(1, [1e15, 1.0], 1), (2, [1e15, 2.0], 1)], "vec_id BIGINT, embedding ARRAY<DOUBLE>, label INT")
    with pytest.raises(Exception, match="62 bits"):
        hard_negatives.mine(huge, F.lit(True)).collect()


def test_the_walk_stops_before_the_end_of_the_lists():
    rng = np.random.default_rng(4)
    values = rng.integers(-20, 20, (4000, 3)).astype(float)
    values[:5] = [[200, 200, -200]] * 5
    shard = hard_negatives.Shard(np.arange(4000), np.zeros(4000, np.int64), values, hard_negatives.Shard.lists(values))
    best = [[]]
    scored = shard.search(np.array([3.0, 2.0, -1.0]), np.ones(4000, bool), [(None, None)], 5, best)
    assert [i for _, i in best[0]] == [0, 1, 2, 3, 4] and scored < 200


# ---- Periodic runs -----------------------------------------------------------------------------


def expected_runs(words, least=6, times=4):
    """(start, length, smallest period) by comparing every word with the one q on."""
    found, n = {}, len(words)
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, times * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def kept_words(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return [w for i, w in enumerate(words) if i not in gone]


def periodic_words(rng):
    kind = rng.randrange(5)
    if kind == 0:
        return [rng.randrange(2) for _ in range(rng.randrange(80))]
    if kind == 1:
        base = [rng.randrange(3) for _ in range(rng.randrange(1, 14))]
        return [0] * rng.randrange(4) + (base * 8)[: rng.randrange(1, 90)] + [1] * rng.randrange(4)
    if kind == 2:
        parts = [[rng.randrange(2) for _ in range(rng.randrange(1, 5))] * rng.randrange(1, 8) for _ in range(rng.randrange(1, 5))]
        return sum(parts, []) * rng.randrange(1, 6)
    if kind == 3:  # nested: a long period full of short ones
        return (([0] * rng.randrange(1, 9) + [1]) * rng.randrange(1, 7) + [2]) * rng.randrange(1, 7)
    a, b = [0], [0, 1]
    for _ in range(rng.randrange(2, 8)):
        a, b = b, b + a
    return b * rng.randrange(1, 5)


def test_runs_of_periodic_texts():
    rng = random.Random(9)
    for _ in range(600):
        texts = [periodic_words(rng) for _ in range(rng.randrange(1, 6))]
        found = list(_of_texts([" ".join(map(str, t)).encode() for t in texts], 6, 4))
        for words, (runs, left) in zip(texts, found):
            want = expected_runs(words)
            assert [tuple(r) for r in runs] == want, words
            assert left.decode().split() == [str(w) for w in kept_words(words, want)]


def test_grammar_derives_the_words():
    rng = random.Random(2)
    for _ in range(200):
        words = np.array(periodic_words(rng) + [9], np.int64)
        made = grammar(words)
        for r in range(len(made.start)):
            places = made.at[made.rule == r]
            size = made.stop[r] - made.start[r]
            assert len(places) >= 2 and made.start[r] in places and made.start[r] < made.middle[r] < made.stop[r]
            assert len({tuple(words[p : p + size]) for p in places}) == 1
        # Each replacement takes one symbol away.
        assert len(made.left) == len(words) - len(made.at)


def test_runs_of_one_repeated_word_and_of_long_texts():
    words = np.append(np.zeros(200_000, np.int64), 1)
    assert [x.tolist() for x in find_runs(words, np.array([0, len(words)]))] == [[0], [200_000], [1]]
    rng = random.Random(6)
    body = [f"w{rng.randrange(300)}" for _ in range(150_000)]
    body[50_000:50_040] = ["x", "y", "z", "u"] * 10
    (runs, left), = _of_texts([" ".join(body).encode()], 6, 4)
    assert [50_000, 40, 4] in runs and len(left.split()) <= len(body) - 36


def test_runs_of_odd_documents(odd, empty):
    found = periodic_runs(odd)
    assert found.columns == [*odd.columns, "runs", "collapsed"]
    for r in found.collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")
        assert r["collapsed"] is not None and r[CLASHING[0]] == "x"
        if len(words) < 3000:
            want = expected_runs(words)
            assert [tuple(x) for x in r["runs"]] == want and r["collapsed"] == " ".join(kept_words(words, want))
    assert periodic_runs(empty).count() == 0
    assert periodic_runs(odd.withColumn("runs", F.lit(1))).columns == found.columns


def test_the_query_on_the_smallest_documents(spark):
    sf = "/root/testdata/sf0.001"
    found = {r["doc_id"]: r for r in QUERIES["op13_periodic_runs"](spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(found) == len(rows) and SCHEMA.startswith("doc_id BIGINT")
    planted = 0
    for doc_id, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        if n > 4000:
            continue
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            planted += 1
        runs = expected_runs(words)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        assert tuple(found[doc_id]) == (
            doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(" ".join(kept_words(words, runs)).encode()).hexdigest(),
        )
    assert planted > 5
