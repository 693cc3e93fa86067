"""Sets of tables that change as a whole."""

import tempfile

import pytest
from pyspark.sql import functions as F

from marketlens.sources import manifest
from marketlens.sources.processed import load_orders
from marketlens.sources.sinks import write_marts


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _broken(spark, schema):
    df = spark.range(3).select(F.when(F.col("id") == 2, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long").alias("k"))
    return df.select("k", F.lit("x").alias("v"))


def test_a_write_that_dies_leaves_the_former_set(spark):
    root = tempfile.mkdtemp(prefix="marketlens-set-")
    a1, b1 = (spark.createDataFrame([(1, s), (2, s)], "k long, v string") for s in ("a1", "b1"))
    write_marts({"a": a1, "b": b1}, root)
    with pytest.raises(Exception, match="lost"):
        write_marts({"a": spark.createDataFrame([(9, "a2")], "k long, v string"), "b": _broken(spark, a1.schema)}, root)
    assert _rows(manifest.read_table(spark, root, "a")) == [(1, "a1"), (2, "a1")]
    assert _rows(manifest.read_table(spark, root, "b")) == [(1, "b1"), (2, "b1")]
    # the next write is whole again; the former version can still be read
    write_marts({"a": spark.createDataFrame([(9, "a2")], "k long, v string")}, root)
    assert _rows(manifest.read_table(spark, root, "a")) == [(9, "a2")]
    assert _rows(manifest.read_table(spark, root, "b")) == [(1, "b1"), (2, "b1")]
    assert _rows(manifest.read_table(spark, root, "a", version=1)) == [(1, "a1"), (2, "a1")]
    # a manifest whose job died is not there: its file lies in _temporary
    assert {e["version"] for e in manifest.manifests(spark, root).collect()} == {1, 2}


MONTH = "purchase_month_label"


def _orders(spark, rows):
    return spark.createDataFrame(rows, f"order_id long, {MONTH} string, v string")


def test_months_are_replaced_alone(spark):
    root = tempfile.mkdtemp(prefix="marketlens-set-")
    by = {"orders_master": MONTH}
    write_marts({"orders_master": _orders(spark, [(1, "2020-01", "a"), (2, "2020-02", "a"), (3, "2020-03", "a"), (4, None, "a")])}, root, partition_by=by)
    write_marts({"orders_master": _orders(spark, [(5, "2020-02", "b"), (6, "2020-04", "b")])}, root, partition_by=by, replace_parts=True)
    got = load_orders(spark, root)
    assert got.columns == ["order_id", MONTH, "v"]
    assert _rows(got) == sorted([(1, "2020-01", "a"), (3, "2020-03", "a"), (4, None, "a"), (5, "2020-02", "b"), (6, "2020-04", "b")], key=repr)
    some = load_orders(spark, root, first_month="2020-02", last_month="2020-03")
    assert _rows(some) == [(3, "2020-03", "a"), (5, "2020-02", "b")]
    plan = some._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "PartitionFilters" in line]
    assert scans and all("PartitionFilters: []" not in line for line in scans)
    assert len(some.inputFiles()) <= len(got.inputFiles())
    # without replace_parts the table is what was written
    write_marts({"orders_master": _orders(spark, [(7, "2020-05", "c")])}, root, partition_by=by)
    assert _rows(load_orders(spark, root)) == [(7, "2020-05", "c")]


def test_schema_is_checked_and_empty_tables_keep_theirs(spark):
    root = tempfile.mkdtemp(prefix="marketlens-set-")
    df = _orders(spark, [])
    write_marts({"orders_master": df, "plain": df}, root, partition_by={"orders_master": MONTH})
    for name in ("orders_master", "plain"):
        back = manifest.read_table(spark, root, name, df.schema)
        assert back.dtypes == df.dtypes and back.count() == 0
    with pytest.raises(ValueError, match="order_id"):
        manifest.read_table(spark, root, "plain", df.withColumn("order_id", F.col("order_id").cast("string")).schema)
    with pytest.raises(LookupError):
        manifest.read_table(spark, root, "none")
    with pytest.raises(LookupError):
        manifest.read_table(spark, tempfile.mkdtemp(prefix="marketlens-set-"), "plain")


def test_csv_sets(spark):
    root = tempfile.mkdtemp(prefix="marketlens-set-")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    write_marts({"t": df}, root, fmt="csv")
    assert _rows(manifest.read_table(spark, root, "t")) == [(1, "a"), (2, "b")]
