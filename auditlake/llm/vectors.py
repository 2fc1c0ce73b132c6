"""Near-duplicate embeddings by navigable small-world graphs, one per shard.

Vectors of one label (and length) are dealt to shards by hash; equal vectors are one point with a
weight. Every shard's graph is built once. Every shard's points query every shard of their label,
each pair of shards in one task. A query whose beam is full of links widens its beam, and is compared with all
points of the shard where that is cheaper (dense groups) or the beam would hold them all anyway. Links are
verified by cosine in double precision. Tasks give per-point sums and one link per point to its component.

Recall is audited twice. Each pair of shards compares a fixed share of its queries, evenly spaced, with all
points: the beam doubles until it holds the nearest point of ``NEAREST`` of them, which is harder than finding
links and gives evidence where links are few. Their true and found links are summed per label, with those of
all labels standing in for a label that has too few; labels below ``RECALL`` are searched again with twice the beam.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components, and rows with a
null label or id, link with nothing; vectors of different length are not compared; equal rows are
linked rows; an empty table gives an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlake.llm import hnsw
from auditlake.llm.common import staged
from auditlake.llm.components import components

COSINE = 0.93
RECALL = 0.995
SHARD_ROWS = 16_384
BEAM = 48
NEAREST = 0.9
# Of each pair of shards one query in so many is audited, some at least and AUDIT at most.
AUDIT, AUDIT_SHARE, AUDIT_LEAST = 256, 64, 16
# A label with fewer audited true links is judged by the links of all labels.
AUDIT_LINKS = 200
# Float error of the search; candidates this far below the threshold are verified too.
MARGIN = 1e-3
BLOCK = 512
# A widened beam costs about as much as a comparison with this many times as many points.
WIDE = 32
GROUP = ["label", "dim"]
FIGURES = ["audit_true", "audit_found", "audited", "whole", "queries"]


def _whole(vector):
    """True where a vector has only finite components, and one that is not zero."""

    def finite(x):
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))

    return F.coalesce(F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


def usable(rows: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``vec_id``, ``label``, ``vector`` (doubles), ``dim`` of the rows that may link."""
    given = rows.select(
        F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("vector")
    )
    return given.where("label is not null and vec_id is not null").where(_whole(F.col("vector"))).withColumn("dim", F.size("vector"))


def _unit(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column as unit vectors; scaled by the largest component first."""
    flat = column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten()
    vectors = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    vectors = vectors / np.abs(vectors).max(1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def in_order(table: pa.Table) -> pa.Table:
    """Points in the order of their hashes, which is random and the same in every task."""
    return table.sort_by([("key_a", "ascending"), ("key_b", "ascending")])


def graphs(points: DataFrame) -> DataFrame:
    """One row per shard: its graph."""

    def run(key, table):
        vectors = _unit(in_order(table).column("vector"), key[1].as_py()).astype(np.float32)
        graph = hnsw.pack_layers(hnsw.build(vectors))
        return pa.table({**{k: table.column(k)[:1] for k in (*GROUP, "shard")}, "graph": pa.array([graph], pa.binary())})

    kind = points.schema["label"].dataType.simpleString()
    return points.groupBy(*GROUP, "shard").applyInArrow(run, f"label {kind}, dim int, shard bigint, graph binary")


def merge(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Roots (least members) of the points after joining every a with its b."""
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        apart = low != high
        if not apart.any():
            return root
        parent = np.arange(len(root))
        np.minimum.at(parent, high[apart], low[apart])
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up
        root = parent[root]


class ShardPair:
    """Links between the points of two shards (or within one)."""

    def __init__(self, queries, query_weights, points, weights, layers, same, cosine):
        self.q, self.qw, self.p, self.w = queries, query_weights, points, weights
        self.q32, self.p32 = queries.astype(np.float32), points.astype(np.float32)
        self.layers, self.same, self.cosine = layers, same, cosine
        self.shift = 0 if same else len(queries)  # place of the points among all
        total = len(queries) + (0 if same else len(points))
        self.links, self.root = np.zeros(total, np.int64), np.arange(total)
        self.whole = np.zeros(len(queries), bool)  # queries compared with all points
        self.best = np.full(len(queries), -np.inf)  # similarity of the nearest point met
        self.true = self.found = self.audited = 0

    def _exact(self, rows: np.ndarray) -> np.ndarray:
        near = self.q[rows] @ self.p.T >= self.cosine
        if self.same:
            near[np.arange(len(rows)), rows] = False
        return near

    def _verified(self, rows, ids, sims):
        """Pairs (query, point) of candidates that are links."""
        r, c = np.nonzero((ids >= 0) & (sims >= self.cosine - MARGIN))
        a, b = rows[r], ids[r, c].astype(np.int64)
        sure = np.einsum("ij,ij->i", self.q[a], self.p[b]) >= self.cosine
        if self.same:
            sure &= a != b
        return a[sure], b[sure]

    def _search(self, rows: np.ndarray, beam: int):
        """Links of the queries; beams full of links widen while that is cheaper than all points."""
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        narrow = beam
        while len(rows):
            if beam * (WIDE if beam > narrow else 1) >= len(self.p):
                self.whole[rows] = True
                break
            full = []
            for begin in range(0, len(rows), BLOCK):
                part = rows[begin : begin + BLOCK]
                ids, sims = hnsw.search(self.p32, self.layers, self.q32[part], beam)
                other = ids != part[:, None] if self.same else ids >= 0
                self.best[part] = np.where(other & (ids >= 0), sims, -np.inf).max(1)
                is_full = sims.min(1) >= self.cosine - MARGIN
                full.append(part[is_full])
                found.append(self._verified(part[~is_full], ids[~is_full], sims[~is_full]))
            rows, beam = np.concatenate(full), 2 * beam
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def _audit(self, a) -> float:
        """Counts true and found links of evenly spaced queries; the share of those whose nearest point was met.
        Queries that are compared with all points need no audit."""
        n = len(self.q)
        rows = np.unique(np.linspace(0, n - 1, min(n, AUDIT, max(AUDIT_LEAST, n // AUDIT_SHARE))).astype(int))
        rows = rows[~self.whole[rows]]
        got = np.bincount(a, minlength=n)
        self.true, self.found, self.audited, met = 0, 0, len(rows), 0
        for begin in range(0, len(rows), 64):
            part = rows[begin : begin + 64]
            sims = self.q[part] @ self.p.T
            if self.same:
                sims[np.arange(len(part)), part] = -np.inf
            self.true += int((sims >= self.cosine).sum())
            self.found += int(got[part].sum())
            met += int((self.best[part] >= sims.max(1) - MARGIN).sum())
        return met / len(rows) if len(rows) else 1.0

    def run(self, beam: int = BEAM):
        while True:
            self.whole[:] = False
            a, b = self._search(np.arange(len(self.q)), beam)
            if self._audit(a) >= NEAREST:
                break
            beam *= 2
        # Pairs between queries that were not compared with all; found from either side.
        if self.same:
            open_pair = ~self.whole[a] & ~self.whole[b]
            a, b = a[open_pair], b[open_pair]
            pairs = np.unique(np.minimum(a, b) * len(self.p) + np.maximum(a, b))
            a, b = pairs // len(self.p), pairs % len(self.p)
        np.add.at(self.links, a, self.w[b])
        np.add.at(self.links, b + self.shift, self.qw[a])
        self.root = merge(self.root, a, b + self.shift)
        exact = np.flatnonzero(self.whole)
        for begin in range(0, len(exact), 64):
            part = exact[begin : begin + 64]
            near = self._exact(part)
            self.links[part] += near @ self.w
            # The other side of these pairs, where it is not itself compared with all.
            other = self.qw[part] @ near
            if self.same:
                other[self.whole] = 0
            self.links[self.shift : self.shift + len(self.p)] += other
            r, c = np.nonzero(near)
            self.root = merge(self.root, part[r], c + self.shift)


def linked(points: DataFrame, built: DataFrame, cosine: float = COSINE, beam: int = BEAM) -> DataFrame:
    """Per task and point: ``rep``, ``links`` and ``root``, the representative it is linked to; and per task a row
    without ``rep`` with the true and found links of its audit, and the queries that were compared with all points."""

    def run(key, left, right):
        dim, i, j = key[1].as_py(), key[2].as_py(), key[3].as_py()
        shard = left.column("shard").to_numpy()
        sides = [in_order(left.filter(pa.array(shard == s))) for s in ((i,) if i == j else (i, j))]
        vectors = [_unit(s.column("vector"), dim) for s in sides]
        weights = [s.column("weight").to_numpy() for s in sides]
        layers = hnsw.unpack_layers(right.column("graph")[0].as_py(), sides[-1].num_rows)
        pair = ShardPair(vectors[0], weights[0], vectors[-1], weights[-1], layers, i == j, cosine)
        pair.run(beam)
        reps = np.concatenate([s.column("rep").to_numpy() for s in sides])
        on = pair.links > 0
        n = int(on.sum()) + 1
        figures = {"audit_true": pair.true, "audit_found": pair.found, "audited": pair.audited, "whole": int(pair.whole.sum()), "queries": len(pair.q)}
        return pa.table(
            {
                **{k: pa.repeat(key[at], n) for at, k in enumerate(GROUP)},
                "rep": pa.array([None, *reps[on].tolist()], pa.int64()),
                "links": pa.array([None, *pair.links[on].tolist()], pa.int64()),
                "root": pa.array([None, *reps[pair.root[on]].tolist()], pa.int64()),
                **{k: pa.array([v] + [None] * (n - 1), pa.int64()) for k, v in figures.items()},
            }
        )

    kind = points.schema["label"].dataType.simpleString()
    out = f"label {kind}, dim int, rep bigint, links bigint, root bigint, " + ", ".join(f"{f} bigint" for f in FIGURES)
    low, high = F.least("shard", "other"), F.greatest("shard", "other")
    others = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("shards") - 1)).alias("other")
    left = points.select("*", others).withColumns({"i": high, "j": low})
    shards = points.groupBy(*GROUP).agg(F.first("shards").alias("shards"))
    right = built.join(shards, GROUP).select(
        *GROUP, F.explode(F.sequence(F.col("shard"), F.col("shards") - 1)).alias("i"), F.col("shard").alias("j"), "graph"
    )
    keys = [*GROUP, "i", "j"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, out)


def audited_links(points: DataFrame, cosine: float = COSINE, beam: int = BEAM) -> tuple[DataFrame, DataFrame]:
    """All links, and the audits of the last search of every label; weak labels are searched with wider beams."""
    built = staged(graphs(points), "graphs")
    links, audits = [], []
    while True:
        found = staged(linked(points, built, cosine, beam), "vector-links")
        is_audit = F.col("rep").isNull()
        audit = found.where(is_audit).groupBy(*GROUP).agg(*[F.sum(f).alias(f) for f in FIGURES])
        true, hit, largest = audit.agg(F.sum("audit_true"), F.sum("audit_found"), F.max("queries")).first()
        pooled = hit / true if true else 1.0
        own = F.when(F.col("audit_true") >= AUDIT_LINKS, F.col("audit_found") / F.col("audit_true"))
        audit = audit.withColumns({"recall": F.coalesce(own, F.lit(pooled)), "beam": F.lit(beam)})
        weak = staged(audit.where(F.col("recall") < RECALL).select(*GROUP), "weak-labels")
        # A beam of all points is a comparison with all of them.
        if beam >= (largest or 0) or weak.isEmpty():
            links.append(found.where(~is_audit))
            audits.append(audit)
            break
        links.append(found.where(~is_audit).join(weak, GROUP, "left_anti"))
        audits.append(audit.join(weak, GROUP, "left_anti"))
        points, built, beam = points.join(weak, GROUP, "left_semi"), built.join(weak, GROUP, "left_semi"), 2 * beam
    return reduce(DataFrame.unionByName, links), reduce(DataFrame.unionByName, audits)


def near_duplicates(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    cosine: float = COSINE,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """Per row: ``vec_id``, ``n_links``, ``component_id``, ``kept``."""
    good = usable(rows, id_col, vector_col, label_col)
    keys = {"key_a": F.xxhash64("label", "vector"), "key_b": F.xxhash64(F.lit("second"), "label", "vector")}
    keyed = good.withColumns(keys)
    members = staged(keyed.select("vec_id", "key_a", "key_b"), "vector-members")
    distinct = keyed.groupBy("key_a", "key_b").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("weight"), F.first("label").alias("label"),
        F.first("vector").alias("vector"), F.first("dim").alias("dim"),
    )
    held = staged(distinct, "vector-points")
    per_label = held.groupBy(*GROUP).agg(F.ceil(F.count(F.lit(1)) / shard_rows).alias("shards"))
    points = held.join(per_label, GROUP).withColumn("shard", F.pmod(F.xxhash64("key_b", "key_a"), "shards"))
    found, _ = audited_links(points, cosine)
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    merged = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "rep")
    verdicts = (
        held.select("key_a", "key_b", "rep", "weight")
        .join(counts, "rep", "left")
        .join(merged, "rep", "left")
        .select(
            "key_a", "key_b", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    linking = members.join(verdicts, ["key_a", "key_b"]).select("vec_id", "n_links", "component_id")
    # The other rows: the same test, negated, so that every row is in one of the two.
    whole = _whole(F.col(vector_col).cast("array<double>"))
    alone = rows.where(F.col(label_col).isNull() | F.col(id_col).isNull() | ~whole).select(
        F.col(id_col).alias("vec_id"), F.lit(0).cast("bigint").alias("n_links"), F.col(id_col).alias("component_id")
    )
    return linking.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
