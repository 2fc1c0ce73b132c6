"""Tables derived from each other, brought up to date in the order of their inputs.

A layer is derived again when what it was derived from is no longer what is there: another version of its
code, other files in a source, other content of a layer before it. The state holds one row for each time a layer
was derived, written when its folder is whole: a refresh that fails goes on from there, and readers of older
folders are not disturbed. A layer whose content came out the same leaves the layers behind it as they are.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlake.operators.quality import fingerprint

STATE_DDL = "layer STRING, folder STRING, input_key STRING, row_count BIGINT, content_hash STRING, derived_at TIMESTAMP"
Derive = Callable[[dict[str, str], str, str], None]


@dataclass(frozen=True)
class Layer:
    """``derive`` gets (folders of the inputs, target folder, fresh checkpoint folder).

    Inputs are sources or layers. Raise ``version`` when the code changes. ``columns`` are those of the
    fingerprint, all if none: leave out columns that differ from run to run, like times of reading.
    """

    name: str
    inputs: tuple[str, ...]
    derive: Derive
    version: str = "1"
    columns: tuple[str, ...] = ()


def source_key(spark: SparkSession, folder: str) -> str:
    """Tells whether the files of a folder are still the same, from their listing."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    files = listed.select("path", "length", "modificationTime")
    found = files.agg(F.count(F.lit(1)), F.sum("length"), F.bit_xor(F.xxhash64(*files.columns))).first()
    return ":".join(map(str, found))


def state(spark: SparkSession, root: str) -> DataFrame:
    """The newest row of every layer."""
    try:
        rows = spark.read.schema(STATE_DDL).parquet(f"{root}/state")
    except Exception as error:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(error):
            raise
        rows = spark.createDataFrame([], STATE_DDL)
    newest = rows.groupBy("layer").agg(F.max_by(F.struct(*rows.columns), "derived_at").alias("row"))
    return newest.select("row.*")


def refresh(
    spark: SparkSession, root: str, sources: Mapping[str, str], layers: Sequence[Layer], full: bool = False
) -> list[str]:
    """Derive the stale layers, or all of them if ``full``, and return their names in order."""
    by_name = {layer.name: layer for layer in layers}
    for layer in layers:
        if missing := [i for i in layer.inputs if i not in sources and i not in by_name]:
            raise KeyError(f"{layer.name} reads {', '.join(missing)}, which is neither a source nor a layer")
    order = TopologicalSorter({n: [i for i in layer.inputs if i in by_name] for n, layer in by_name.items()}).static_order()
    known = {r["layer"]: r for r in state(spark, root).collect()}  # one row per layer
    folders = dict(sources)
    keys = {name: source_key(spark, folder) for name, folder in sources.items()}
    derived = []
    for layer in map(by_name.__getitem__, order):
        told = [layer.version, *[f"{i}={keys[i]}" for i in layer.inputs]]
        input_key = hashlib.sha256("\n".join(told).encode()).hexdigest()
        at = known.get(layer.name)
        if full or at is None or at["input_key"] != input_key:
            at = _derive(spark, root, layer, {i: folders[i] for i in layer.inputs}, input_key)
            derived.append(layer.name)
        folders[layer.name] = at["folder"]
        keys[layer.name] = f"{at['row_count']}:{at['content_hash']}"
    return derived


def _derive(spark: SparkSession, root: str, layer: Layer, inputs: dict[str, str], input_key: str) -> dict:
    attempt = f"{layer.name}-{uuid.uuid4().hex}"
    target = f"{root}/tables/{attempt}"
    layer.derive(inputs, target, f"{root}/checkpoints/{attempt}")
    rows = spark.read.parquet(target)
    content = fingerprint(rows, layer.columns or rows.columns).first().asDict()
    at = {"layer": layer.name, "folder": target, "input_key": input_key, **content}
    told = spark.range(1).select(*[F.lit(v).alias(k) for k, v in at.items()], F.current_timestamp().alias("derived_at"))
    told.coalesce(1).write.mode("append").parquet(f"{root}/state")
    return at


def read_layer(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A layer as derived last."""
    at = state(spark, root).where(F.col("layer") == name).first()
    if at is None:
        raise LookupError(f"{name} has not been derived")
    return spark.read.parquet(at["folder"])
