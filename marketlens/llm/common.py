"""Helpers shared by the training-data operators."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def save(df: DataFrame) -> DataFrame:
    """Materialise in the shared ``spark.checkpoint.dir`` and cut the lineage;
    the copy survives the loss of any executor."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def partitions_for(spark: SparkSession, rows: int, rows_each: int) -> int:
    """A partition count that follows the data, at least the session's own."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / rows_each))


def whole(text: Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(text, F.lit(""))


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores put after it until no column of ``df``
    is called so (in any case, as Spark compares names)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


#: At most this many nodes or keys are treated as hot, so the table of hot
#: keys, which is broadcast, has a fixed bound.
MAX_HOT = 10_000
SALTS = 32


def _with_minimum(both: DataFrame, n_edges: int) -> DataFrame:
    """``both`` (u, v) with the smallest of u and its neighbours as ``m``.
    The few nodes with very many neighbours are salted in the join back."""
    mins = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("deg"))
    mins = mins.select("u", F.least("u", "m").alias("m"), "deg")
    limit = max(50_000, math.ceil(2 * n_edges / MAX_HOT))
    if n_edges <= limit:
        return both.join(mins.drop("deg"), "u")
    mins = save(mins)
    hot = F.broadcast(mins.where(F.col("deg") > limit).select("u", F.lit(True).alias("hot")))
    salted = both.join(hot, "u", "left").withColumn(
        "salt", F.when(F.col("hot"), F.pmod(F.xxhash64("v"), F.lit(SALTS))).otherwise(F.lit(0).cast("long")))
    spread = mins.withColumn("salt", F.explode(F.when(
        F.col("deg") > limit, F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))
    ).otherwise(F.array(F.lit(0).cast("long"))))).drop("deg")
    return salted.drop("hot").join(spread, ["u", "salt"]).drop("salt")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): every node of ``edges`` with the smallest node it can
    reach. Alternates the large-star and small-star steps until the edges stand
    still; each round is written to the checkpoint folder. Nothing but counts
    and one checksum reaches the driver. No edges: an empty result."""
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    e = save(e)
    seen = None
    while True:
        n, check = e.agg(F.count(F.lit(1)), F.coalesce(
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))).first()
        if (n, check) == seen or n == 0:
            break
        seen = (n, check)
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_minimum(both, 2 * n).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = save(large)
        near = _with_minimum(large, n)
        small = near.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            near.select("u", F.col("m").alias("v")))
        e = save(small.distinct())
    roots = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
