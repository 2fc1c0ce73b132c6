"""Documents put together from the same few passages: no link is lost, and they are not all compared."""

import random

import numpy as np
import pyarrow as pa
import pytest
from test_odd_documents import brute_components, counted

from auditlake.llm import jaccard

COLUMNS = ("doc_id", "n_shingles", "component_id")


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(5)
    for _ in range(400):
        n = int(rng.integers(1, 400))
        a = rng.integers(1, 2**63, n).astype(np.uint64)
        gone = int(rng.integers(0, n // 5 + 1))
        new = int(rng.integers(0, max(0, (100 * (n - gone) - 80 * n) // 80) + 1))
        b = np.append(rng.permutation(a)[gone:], rng.integers(1, 2**63, new).astype(np.uint64))
        both = n - gone
        if not both or 100 * both < 80 * (n + new):
            continue
        assert set(jaccard.part_signs(a, n)) & set(jaccard.part_signs(b, len(b))), (n, gone, new)


def test_sizes_of_similar_sets_are_in_neighbouring_groups():
    for n in range(1, 3000):
        group, own, following = jaccard.size_group(n)
        widest = n * 100 // 80
        assert n <= own and widest <= following and jaccard.size_group(widest)[0] in (group, group + 1)
        assert jaccard.size_group(own) == (group, own, following) and jaccard.size_group(own + 1)[:2] == (group + 1, following)


def passages(rng, docs, of=10, common=20, words=30):
    told = [" ".join(f"p{p}w{rng.randrange(500)}" for _ in range(words)) for p in range(common)]
    seen, rows = set(), []
    while len(rows) < docs:
        chosen = tuple(sorted(rng.sample(range(common), of)))
        if chosen not in seen:
            seen.add(chosen)
            rows.append((len(rows), " ".join(told[p] for p in chosen)))
    return rows


@pytest.mark.parametrize("crowd", [1, 6])
def test_crowded_signatures_equal_brute_force(spark, odd, monkeypatch, crowd):
    monkeypatch.setattr(jaccard, "CROWD", crowd)
    monkeypatch.setattr(jaccard, "CENTRES", 1)
    rng = random.Random(crowd)
    rows = passages(rng, 40)
    for i, text in rows[:12]:
        words = text.split(" ")
        for at in rng.sample(range(len(words)), 2 + i % 5):
            words[at] = "new"
        rows.append((len(rows), " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    assert counted(jaccard.near_duplicates(docs, frequent=2), *COLUMNS) == brute_components(rows)
    odd_rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    assert counted(jaccard.near_duplicates(odd, frequent=2), *COLUMNS) == brute_components(odd_rows)


def test_texts_of_one_hash_are_told_apart(spark, monkeypatch):
    plain = jaccard.normalized
    monkeypatch.setattr(jaccard, "normalized", lambda *a: plain(*a).withColumn("key_a", jaccard.F.lit(7).cast("bigint")))
    rng = random.Random(2)
    rows = passages(rng, 12)
    rows += [(20, rows[0][1] + " and one"), (21, rows[1][1]), (22, "a b c"), (23, None)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    assert counted(jaccard.near_duplicates(docs), *COLUMNS) == brute_components(rows)


def joined_rows(postings):
    per_sign = postings.groupBy("sign").agg(jaccard.F.count(jaccard.F.lit(1)).alias("c"))
    return int(per_sign.agg(jaccard.F.sum(jaccard.F.expr("c * (c - 1) div 2"))).first()[0] or 0)


def pairs_met(spark, monkeypatch, docs):
    """Rows of the last joins, and what they would be if all documents of a signature were paired."""
    met, every, between, left_over = [], [], jaccard._between, jaccard.left_over
    monkeypatch.setattr(jaccard, "_between", lambda p: met.append(joined_rows(p)) or between(p))
    monkeypatch.setattr(jaccard, "left_over", lambda live, found: every.append(joined_rows(live)) or left_over(live, found))
    rows = passages(random.Random(9), docs)
    jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id BIGINT, text STRING")).count()
    monkeypatch.undo()
    return met, every


def test_documents_of_the_same_passages_are_not_all_compared(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "CROWD", 16)  # few documents here
    (few, parts), (every,) = pairs_met(spark, monkeypatch, 250)
    assert few + parts < every / 2, (few, parts, every)


def changed_copies(rng, copies, size=145, gone=20):
    """Own tokens and shared ones of copies of one set, each with changes of its own."""
    base = rng.integers(1, 2**63, size).astype(np.uint64)
    return [(rng.permutation(base)[gone:], size, gone) for _ in range(copies)]


def test_changed_copies_of_one_text_seldom_meet():
    sets = changed_copies(np.random.default_rng(6), 300)
    sides: dict[int, tuple[list, list]] = {}
    for i, (tokens, n, own) in enumerate(sets):
        for sign, side in zip(*(x.tolist() for x in jaccard.sided_signs(tokens, n, own))):
            low, high = sides.setdefault(sign, ([], []))
            low += [i] * (side <= 0)
            high += [i] * (side >= 0)
    met = sum(1 for low, high in sides.values() for a in low for b in high if a < b)
    plain: dict[int, int] = {}
    for tokens, n, _ in sets:
        for sign in jaccard.part_signs(tokens, n).tolist():
            plain[sign] = plain.get(sign, 0) + 1
    assert met < 300 * 299 / 2 / 20 < sum(c * (c - 1) // 2 for c in plain.values())


def test_similar_sets_with_own_tokens_meet_from_opposite_sides():
    rng = np.random.default_rng(8)
    seen = 0
    for _ in range(600):
        both = rng.integers(1, 2**63, int(rng.integers(4, 300))).astype(np.uint64)
        sets = []
        for _ in range(2):
            own = int(rng.integers(0, len(both) // 8 + 1))
            more = rng.integers(1, 2**63, int(rng.integers(0, len(both) // 8 + 1))).astype(np.uint64)
            sets.append((np.append(both, more), len(both) + len(more) + own, own))
        if 100 * len(both) < 80 * (sets[0][1] + sets[1][1] - len(both)):
            continue
        seen += 1
        (a, sides_a), (b, sides_b) = (jaccard.sided_signs(*s) for s in sets)
        side = dict(zip(a.tolist(), sides_a.tolist()))
        assert any(side.get(s, 9) == -t for s, t in zip(b.tolist(), sides_b.tolist())), sets
    assert seen > 100


def test_pairs_that_sketches_rule_out_are_never_rows(spark):
    rng = np.random.default_rng(12)
    sets = [(tokens, n) for tokens, n, _ in changed_copies(rng, 40, gone=45)]
    sets.append((sets[0][0][1:], sets[0][1] - 1))  # similar to the first
    rows = [(7, 0, i, n, n - len(t), i, jaccard.parity_sketch(t).tolist()) for i, (t, n) in enumerate(sets)]
    names = "sign BIGINT, side TINYINT, node BIGINT, n BIGINT, own BIGINT, comp BIGINT, sketch ARRAY<BIGINT>"
    # Sets whose own tokens alone would let them be similar, told apart by their sketches.
    postings = spark.createDataFrame([(*r[:4], 0, *r[5:]) for r in rows], names)
    met = {(r["a"], r["b"]) for r in jaccard._between(postings).collect()}
    plain = jaccard._between(postings.drop("sketch")).count()
    assert (0, 40) in met and len(met) < plain / 20, (len(met), plain)


def test_signatures_of_a_crowd_leave_in_bounded_batches():
    """A batch of long documents has some twenty signatures a token: they come in small batches, none is lost."""
    rng = np.random.default_rng(11)
    rows = [(k, size, own, rng.integers(1, 2**63, size - own, dtype=np.int64)) for k, (size, own) in enumerate([(2000, 0)] * 12 + [(30, 2), (16000, 0), (9, 9)])]
    node, n, own, tokens = zip(*rows)
    whole = lambda x: pa.array(x, pa.int64())
    batch = pa.RecordBatch.from_arrays([whole(node), whole(n), whole(own), whole(node), pa.array(tokens, pa.list_(pa.int64()))], ["node", "n", "own", "comp", "tokens"])
    found, most = {}, 1 << 18
    for made in jaccard._with_part_signs([batch]):
        assert 0 < sum(len(s) for s in made.column("signs")) <= most
        for row in made.to_pylist():
            assert (row["n"], row["own"], row["comp"]) == (n[row["node"]], own[row["node"]], row["node"])
            signs, sides = found.setdefault(row["node"], ([], []))
            signs += row["signs"]
            sides += row["sides"]
    for k, size, alone, t in rows:
        signs, sides = jaccard.sided_signs(t.view(np.uint64), size, alone)
        assert found.get(k, ([], [])) == (signs.view(np.int64).tolist(), sides.tolist())
    assert len(found[13][0]) > most
