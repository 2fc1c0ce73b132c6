"""The audit of the graph search where links are few."""

import numpy as np

from auditlake.llm import hnsw, vectors


def test_the_audit_sees_links_outside_its_first_queries(monkeypatch):
    rng = np.random.default_rng(4)
    points = rng.normal(size=(1200, 24))
    spaced = set(np.linspace(0, 1199, vectors.AUDIT).astype(int).tolist())
    others = [i for i in range(1200) if i not in spaced]
    twins = [(others[k], others[-1 - k]) for k in range(5)]
    for i, j in twins:
        points[j] = points[i] + 0.01 * rng.normal(size=24)
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    layers = hnsw.unpack_layers(hnsw.pack_layers(hnsw.build(points.astype(np.float32))), len(points))
    search, beams = hnsw.search, []

    def blind_when_narrow(p, graph, q, beam):
        ids, sims = search(p, graph, q, beam)
        beams.append(beam)
        return (np.full_like(ids, -1), np.full_like(sims, -1)) if beam == vectors.BEAM else (ids, sims)

    monkeypatch.setattr(hnsw, "search", blind_when_narrow)
    weights = np.ones(len(points), np.int64)
    pair = vectors.ShardPair(points, weights, points, weights, layers, True, vectors.COSINE)
    pair.run()
    near = points @ points.T >= vectors.COSINE
    assert (pair.links == near.sum(1) - 1).all() and pair.links.sum() >= 10 and max(beams) > vectors.BEAM


def test_pooled_audits_report_recall_and_weak_labels_are_searched_again(spark, monkeypatch):
    rng = np.random.default_rng(11)
    points = rng.normal(size=(300, 16))
    points[280:] = points[:20] + 0.01 * rng.normal(size=(20, 16))
    rows = [(i, (v / np.linalg.norm(v)).tolist(), i % 2) for i, v in enumerate(points)]
    df = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>, label INT")
    good = vectors.usable(df, "vec_id", "embedding", "label")
    keyed = good.selectExpr("*", "vec_id AS rep", "1L AS weight", "2L AS shards", "xxhash64(vec_id) AS key_a", "vec_id AS key_b")
    dealt = keyed.selectExpr("*", "vec_id DIV 2 % 2 AS shard")
    links, audits = vectors.audited_links(dealt)
    seen = audits.collect()
    # Three pairs of shards a label, a few queries of each compared with all points, none compared whole.
    assert {r["label"] for r in seen} == {0, 1} and all(r["beam"] == vectors.BEAM and r["whole"] == 0 for r in seen)
    assert all(0 < r["audited"] <= 3 * vectors.AUDIT_LEAST and r["recall"] == 1.0 for r in seen)
    assert links.agg({"links": "sum"}).first()[0] == 40
    monkeypatch.setattr(vectors, "RECALL", 1.1)  # no audit with links passes: beams grow to all points
    wide, last = vectors.audited_links(dealt)
    assert wide.agg({"links": "sum"}).first()[0] == 40
    assert all(r["beam"] > vectors.BEAM for r in last.collect() if r["audit_true"])
