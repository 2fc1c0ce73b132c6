"""Hard negatives by Fagin's threshold algorithm.

Rows are sorted by label and cut into shards. A shard holds its rows' integer components and, for every
dimension, the list of its rows sorted by that component. An anchor walks the lists of the dimensions it
has a component in, from the top where that is positive and from the bottom where it is negative. Rows met
in any list are scored whole (random access, integer inner product). What the lists still hold scores at
most the threshold, the sum over the lists of anchor times current component. The walk ends when, for each
window of scores that is asked for, the threshold is strictly below the k-th best score found (an equal one
could still have a smaller id), or below the window, or when every row was met.

First the best rows of the anchor's own label (positives), in the shards that hold the label; then, for each
positive, the best rows of other labels whose score lies in a window below the positive's, in all shards.
What an anchor has found in one shard of a task stands when it goes on to the next one. Shards and their
anchors are files in the shared folder, named by staged rows, so a lost executor repeats tasks only.

Scores are exact: in doubles where 53 bits hold every score times 100, else in 64-bit integers.

Defined cases: rows with a null id, label or vector, or with a null or non-finite component, take no part;
of rows with one id the least (label, components) counts; rows of other lengths than the anchor's never
answer it; a zero anchor scores 0 with all; ties go by smaller id; an empty table gives no rows; scores
beyond 62 bits are refused; columns other than those named are ignored. Labels are integers.
"""

from __future__ import annotations

import io
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auditlake.llm.common import fresh_dir, publish, ranked, shared_fs, staged

SHARD_ROWS = 4096
# Shards that a task walks through with one block of anchors.
SPAN = 4
FIRST_DEPTH = 16


class Shard:
    """Rows of one vector length with the sorted lists of every dimension."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, values: np.ndarray, order: np.ndarray):
        """``order`` lists the rows of each dimension by rising component; ``values`` has the type to score in."""
        self.ids, self.labels, self.values, self.order = ids, labels, values, order
        self.sorted = np.ascontiguousarray(np.take_along_axis(values, order.T, axis=0).T)

    @staticmethod
    def lists(values: np.ndarray) -> np.ndarray:
        return np.argsort(values, axis=0, kind="stable").T.astype(np.int32)

    def search(self, anchor: np.ndarray, able: np.ndarray, windows: list[tuple], k: int, best: list[list[tuple]]):
        """Bring ``best``, up to k of (-score, id) for each window (low, high), up to date; None is no limit.

        ``able`` tells which rows may answer. Returns how many rows were scored."""
        n = len(self.ids)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        met, scores = np.zeros(n, bool), np.zeros(n, self.values.dtype)
        depth, step, open_windows = 0, FIRST_DEPTH, list(range(len(windows)))
        weights_up, weights_down = anchor[up], anchor[down]
        while open_windows:
            before = met.copy()
            if len(up) + len(down) == 0:
                met[:], depth = True, n
            else:
                upto = min(n, depth + step)
                met[self.order[up, n - upto : n - depth].ravel()] = True
                met[self.order[down, depth:upto].ravel()] = True
                depth, step = upto, 2 * step
            new = np.flatnonzero(met & ~before)
            scores[new] = self.values[new] @ anchor
            new = new[able[new]]
            # No row that was not met scores higher.
            threshold = None
            if depth < n and not met.all():
                threshold = weights_up @ self.sorted[up, n - depth] + weights_down @ self.sorted[down, depth - 1]
            for w in list(open_windows):
                low, high = windows[w]
                fits = new
                if low is not None:
                    fits = new[(100 * scores[new] >= low) & (100 * scores[new] <= high)]
                if len(fits):
                    if len(fits) > k:
                        kth = np.partition(scores[fits], len(fits) - k)[len(fits) - k]
                        fits = fits[scores[fits] >= kth]
                    found = zip((-scores[fits]).tolist(), self.ids[fits].tolist())
                    best[w] = sorted([*best[w], *found])[:k]
                settled = len(best[w]) == k and threshold is not None and threshold < -best[w][-1][0]
                if threshold is None or settled or (low is not None and 100 * threshold < low):
                    open_windows.remove(w)
        return int(met.sum())


def _packed(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _read(folder: str, name: str) -> dict[str, np.ndarray]:
    store, at = shared_fs(folder)
    with store.open_input_file(f"{at}/{name}") as file:
        with np.load(io.BytesIO(file.read())) as held:
            return {k: held[k] for k in held.files}


def _store(rows: DataFrame, folder: str) -> DataFrame:
    """Write each shard; the staged rows name the files and tell which labels and anchors are inside."""

    def write(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        if not table.num_rows:
            return SHARDS.empty_table()
        ids, labels = (table.column(c).to_numpy() for c in ("id", "label"))
        size = table.column("dim")[0].as_py()
        values = table.column("vector").combine_chunks().flatten().to_numpy().reshape(len(ids), size)
        chosen = table.column("anchor").to_numpy(zero_copy_only=False)
        name = uuid.uuid4().hex
        publish(folder, f"{name}.rows", [_packed(ids=ids, labels=labels, values=values, order=Shard.lists(values))])
        publish(folder, f"{name}.anchors", [_packed(ids=ids[chosen], labels=labels[chosen], values=values[chosen])])
        row = {
            "shard": table.column("shard")[0].as_py(), "dim": size, "name": name,
            "labels": np.unique(labels).tolist(), "asking": np.unique(labels[chosen]).tolist(),
        }
        return pa.Table.from_pylist([row], SHARDS)

    grouped = rows.groupBy("shard", "dim").applyInArrow(
        write, "shard bigint, dim int, name string, labels array<bigint>, asking array<bigint>"
    )
    return staged(grouped, "negative-shards")


SHARDS = pa.schema(
    [("shard", pa.int64()), ("dim", pa.int32()), ("name", pa.string()), ("labels", pa.list_(pa.int64())), ("asking", pa.list_(pa.int64()))]
)
FOUND = pa.schema([("anchor_id", pa.int64()), ("window", pa.int32()), ("score", pa.int64()), ("id", pa.int64())])


def _searched(units: DataFrame, folder: str, k: int, same: bool, low: int = 0, high: int = 0) -> DataFrame:
    """Each unit is a block of anchors and a shard; those of one block and span follow one another.

    With ``same``: the k best rows of the anchor's label. Else: for each of the positives that the unit's
    ``asks`` list for an anchor, the k best rows of other labels with low * p <= 100 * score <= high * p.
    """

    def run(batches):
        current, askers, best, wanted = None, None, {}, {}

        def settled():
            rows = [(a, w, -s, i) for a, lists in best.items() for w, one in enumerate(lists) for s, i in one]
            if rows:
                columns = [pa.array([int(x) for x in c], t) for c, t in zip(zip(*rows), FOUND.types)]
                yield pa.RecordBatch.from_arrays(columns, schema=FOUND)

        for batch in batches:
            for unit in batch.to_pylist():
                if (unit["asker"], unit["span"]) != current:
                    yield from settled()
                    current, best = (unit["asker"], unit["span"]), {}
                    askers = _read(folder, f"{unit['asker']}.anchors")
                    wanted = {a["anchor_id"]: a["scores"] for a in unit["asks"]} if not same else {}
                held = _read(folder, f"{unit['name']}.rows")
                own = askers["values"]
                reach = own.shape[1] * int(np.abs(own).max(initial=0)) * int(np.abs(held["values"]).max(initial=0))
                if 100 * reach >= 1 << 62:
                    raise ValueError("scores do not fit into 62 bits")
                kind = np.float64 if 100 * reach < 1 << 53 else np.int64
                shard = Shard(held["ids"], held["labels"], held["values"].astype(kind), held["order"])
                for anchor_id, label, anchor in zip(askers["ids"].tolist(), askers["labels"], own.astype(kind)):
                    if same:
                        windows = [(None, None)]
                        able = (shard.labels == label) & (shard.ids != anchor_id)
                    else:
                        windows = [(low * p, high * p) for p in wanted.get(anchor_id, ())]
                        able = shard.labels != label
                    if windows and able.any():
                        lists = best.setdefault(anchor_id, [[] for _ in windows])
                        shard.search(anchor, able, windows, k, lists)
        yield from settled()

    return units.mapInArrow(run, "anchor_id bigint, window int, score bigint, id bigint")


def _dealt(units: DataFrame) -> DataFrame:
    n = int(units.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return units.repartition(n, "asker", "span").sortWithinPartitions("asker", "span", "shard").drop("shard")


def _best(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    vectors: DataFrame,
    anchors: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    scale: int = 256,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    Components become floor(scale * x). ``anchors`` is a condition on ``vectors``. Anchors' positives are the
    best other rows of their label; the negatives of a positive with score p are the best rows of other
    labels with low * p <= 100 * score <= high * p.
    """
    spark = vectors.sparkSession
    given = vectors.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("bigint").alias("label"),
        F.col(vector_col).alias("vector"), F.coalesce(anchors, F.lit(False)).alias("anchor"),
    )
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform("vector", lambda x: F.floor(F.lit(scale) * x.cast("double")))
    usable = given.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & sound)
    row = F.min(F.struct("label", whole.alias("vector"), "anchor")).alias("row")
    rows = usable.groupBy("id").agg(row).select("id", "row.*", F.size("row.vector").alias("dim"))
    numbered = ranked(rows, [F.col(c) for c in ("dim", "label", "id")], "place", "negative-rows")
    sharded = numbered.withColumn("shard", F.floor(F.col("place") / shard_rows))

    folder = fresh_dir(spark, "negative-files")
    shards = _store(sharded.select("shard", "dim", "id", "label", "vector", "anchor"), folder)
    count = (shards.agg(F.max("shard")).first()[0] or 0) + 1
    span = F.floor(F.col("shard") / SPAN).alias("span")
    asking = shards.where(F.size("asking") > 0).select("dim", F.col("name").alias("asker"), "asking")

    # Positives: shards that hold the label of an anchor in the block.
    holders = shards.select("dim", "shard", "name", F.explode("labels").alias("label"))
    own = asking.select("dim", "asker", F.explode("asking").alias("label")).join(holders, ["dim", "label"])
    own = own.select("asker", span, "shard", "name").distinct()
    found = _searched(_dealt(own), folder, positives, same=True)
    chosen = staged(
        _best(found, ["anchor_id"], positives).select("anchor_id", "rank", F.col("id").alias("positive_id"), "score"), "positives"
    )

    # Negatives: every shard, with the windows of the block's anchors.
    asker_of = sharded.where("anchor").select(F.col("id").alias("anchor_id"), "shard", "dim").join(
        shards.select("shard", "dim", F.col("name").alias("asker")), ["shard", "dim"]
    )
    windows = chosen.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("s"))  # at most ``positives``
    asks = (
        windows.join(asker_of, "anchor_id")
        .groupBy("asker", "dim")  # at most a shard's anchors
        .agg(F.collect_list(F.struct("anchor_id", F.transform("s", lambda x: x["score"]).alias("scores"))).alias("asks"))
    )
    every = staged(asks, "negative-asks").select("asker", "dim", "asks", F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("shard"))
    units = every.join(shards.select("shard", "dim", "name"), ["shard", "dim"]).select("asker", span, "shard", "name", "asks")
    hits = _searched(_dealt(units), folder, negatives, same=False, low=low, high=high)
    hits = hits.withColumn("pos_rank", F.col("window") + 1)
    top = _best(hits, ["anchor_id", "pos_rank"], negatives)
    named = chosen.select("anchor_id", F.col("rank").alias("pos_rank"), "positive_id", F.col("score").alias("positive_score"))
    return top.join(named, ["anchor_id", "pos_rank"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
