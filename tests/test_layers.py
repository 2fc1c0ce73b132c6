from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from auditlake.streaming import layers
from auditlake.streaming.layers import Layer


@pytest.fixture
def built(spark, tmp_path):
    """Numbers, their evens, and a count of these."""
    root, raw, other = (str(tmp_path / n) for n in ("out", "raw", "other"))
    spark.range(10).write.parquet(raw)
    spark.range(3).write.parquet(other)
    read = spark.read.parquet

    def evens(inputs, target, checkpoint):
        read(inputs["raw"]).where("id % 2 = 0").write.parquet(target)

    def counted(inputs, target, checkpoint):
        read(inputs["evens"]).crossJoin(read(inputs["other"]).agg(F.count("*").alias("o"))).agg(F.count("*").alias("n"), F.max("o").alias("o")).write.parquet(target)

    declared = [Layer("counted", ("evens", "other"), counted), Layer("evens", ("raw",), evens)]

    def refresh(changed=None, **settings):
        return layers.refresh(spark, root, {"raw": raw, "other": other}, changed or declared, **settings)

    return root, raw, other, declared, refresh


def test_only_stale_layers_are_derived_in_the_order_of_their_inputs(spark, built):
    root, raw, other, declared, refresh = built
    assert refresh() == ["evens", "counted"] and refresh() == []
    assert layers.read_layer(spark, root, "counted").first().asDict() == {"n": 5, "o": 3}
    spark.range(1).write.mode("append").parquet(other)
    assert refresh() == ["counted"]
    spark.createDataFrame([(11,)], "id BIGINT").write.mode("append").parquet(raw)
    assert refresh() == ["evens"]  # the same content: nothing behind it changes
    spark.createDataFrame([(12,)], "id BIGINT").write.mode("append").parquet(raw)
    assert refresh() == ["evens", "counted"]
    assert layers.read_layer(spark, root, "counted").first().asDict() == {"n": 6, "o": 4}


def test_new_code_and_a_full_refresh_derive_again(spark, built):
    root, raw, other, declared, refresh = built
    refresh()
    old = layers.read_layer(spark, root, "evens")
    assert refresh([declared[0], replace(declared[1], version="2")]) == ["evens"]
    assert refresh([declared[0], replace(declared[1], version="2")], full=True) == ["evens", "counted"]
    assert old.count() == 5


def test_a_refresh_that_fails_goes_on_where_it_stopped(spark, built):
    root, raw, other, declared, refresh = built

    def lost(inputs, target, checkpoint):
        spark.range(4).write.parquet(target)
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        refresh([replace(declared[0], derive=lost), declared[1]])
    with pytest.raises(LookupError):
        layers.read_layer(spark, root, "counted")
    assert refresh() == ["counted"]


def test_inputs_that_do_not_exist_and_circles_are_errors(spark, built):
    root, raw, other, declared, refresh = built
    with pytest.raises(KeyError, match="nothing"):
        refresh([replace(declared[1], inputs=("nothing",))])
    with pytest.raises(ValueError, match="cycle"):
        refresh([declared[0], replace(declared[1], inputs=("counted",))])
