"""Distributed statistics helpers shared by the marts.

The analysed pipeline ranks, takes quantiles and picks per-key rows on one
machine. Here each of those is a plan that never places an unbounded group in
one task. Ranges are taken from the data: rows are dealt to partitions by ranges
whose bounds Spark samples, so bunched values and common prefixes spread like
any others, and the layout is materialised before it is counted.

* ``range_row_number``: ``row_number()`` in a total order: a row's place in its
  range plus the rows of the ranges before.
* ``values_at_ranks`` / ``exact_quantiles``: exact order statistics. Values are
  first collapsed to (value, multiplicity) pairs, the ranges that hold the wanted
  ranks are found from one count a range, and only those are put in order.
* ``with_scalars``: one-row aggregates (national rates, totals, thresholds)
  attached as one scalar subquery; Spark runs it once and inlines the row.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row frame (a global aggregate) to every row
    of ``df`` as one scalar subquery: Spark runs the subquery once and inlines
    its single value — no join, nothing but that row reaches the driver."""
    cols = one_row.columns
    packed = one_row.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("__scalars")).scalar()
    return df.select("*", packed.alias("__scalars")) \
             .select(*[F.col(f"`{c}`") for c in df.columns],
                     *[F.col("__scalars").getField(c).alias(c) for c in cols])


def attach(one_row: DataFrame):
    """``df.transform(attach(one_row))`` == ``with_scalars(df, one_row)``."""
    return lambda df: with_scalars(df, one_row)


SAMPLE_KEYS = 1024


def with_range_bucket(df: DataFrame, key: str, out: str, buckets: int = 64) -> DataFrame:
    """``df`` with an order-preserving bucket (0 .. buckets - 1) of ``key``,
    whose boundaries are taken from the data: every one of SAMPLE_KEYS hash
    classes of the distinct keys lends one key, and evenly spaced ones of
    these, sorted, are the boundaries. So keys with a common prefix, or scores
    in a narrow band, spread like any others. The sample is one row of at most
    SAMPLE_KEYS keys; a null key is in bucket 0."""
    c = F.col(f"`{key}`")
    h = F.xxhash64(c)
    picked = df.where(c.isNotNull()).groupBy(F.pmod(h, F.lit(SAMPLE_KEYS)).alias("__h")).agg(F.min_by(c, h).alias("__k"))
    keys = picked.agg(F.sort_array(F.collect_set("__k")).alias("__s"))
    n = F.size("__s")
    bounds = keys.select(F.array_distinct(F.transform(
        F.filter(F.sequence(F.lit(1), F.lit(buckets - 1)), lambda i: n > 0),
        lambda i: F.element_at(F.col("__s"), (F.floor(i * n / F.lit(buckets)) + 1).cast("int")))).alias("__bounds"))
    found = F.size(F.filter("__bounds", lambda b: b <= c))
    return with_scalars(df, bounds).withColumn(out, F.when(c.isNull(), F.lit(0)).otherwise(found)).drop("__bounds")


def _laid_by_range(df: DataFrame, order_by: Sequence[Column | str], ordered: bool) -> DataFrame:
    """``df`` dealt to partitions by ranges of ``order_by``, and materialised (a
    reliable checkpoint) so that the layout stands still."""
    ensure_checkpoint_dir(df.sparkSession)
    laid = df.repartitionByRange(*order_by)
    return (laid.sortWithinPartitions(*order_by) if ordered else laid).checkpoint()


def range_row_number(df: DataFrame, order_by: Sequence[Column], out: str = "rn") -> DataFrame:
    """``row_number() over (order by order_by)`` with one exchange of the rows.

    The rows are sorted inside ranges of ``order_by``. A row's number is its
    place in its range plus the rows of the ranges before; only that table, one
    row a range, is counted, summed and broadcast. ``order_by`` must be a total
    order: then ties on its first column, however many, lie in many ranges."""
    # the id is the partition's number, then 33 bits of the row's place in it
    own = _laid_by_range(df, order_by, True).withColumn("__id", F.monotonically_increasing_id())
    own = own.withColumn("__part", F.shiftright("__id", 33))
    counts = own.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    place = F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    return own.join(F.broadcast(offsets), "__part").select(
        *[F.col(f"`{c}`") for c in df.columns], (F.col("__before") + place + 1).cast("bigint").alias(out))


def values_at_ranks(df: DataFrame, value: str | Column,
                    ranks: dict[str, Callable[[Column], Column]],
                    keys: Sequence[str] = ()) -> DataFrame:
    """Exact value at 0-based ascending ranks, per group of ``keys``.

    ``ranks`` maps an output name to a function of the group size ``n`` (a
    Column) giving the rank. The distinct values of each group are laid out by
    range; a task orders one range of one group at most, however the values are
    bunched. Returns ``keys``, ``n`` and one double column per rank name. Nulls are ignored. Ranks outside [0, n) give null (a group
    whose wanted ranks are all out of range has no row).
    """
    K = list(keys)
    vcol = F.col(value) if isinstance(value, str) else value
    v = df.select(*K, vcol.cast("double").alias("__v")).where(F.col("__v").isNotNull())
    # distinct values with multiplicity: hot values collapse in the map-side combine
    c = v.groupBy(*K, "__v").agg(F.count(F.lit(1)).alias("__c"))
    c = _laid_by_range(c, [*K, "__v"], False).withColumn("__b", F.spark_partition_id())
    hist = c.groupBy(*K, "__b").agg(F.sum("__c").alias("__bc"))
    wk = Window.partitionBy(*K) if K else Window.partitionBy()
    hist = (hist.withColumn("__hi", F.sum("__bc").over(wk.orderBy("__b")
                            .rowsBetween(Window.unboundedPreceding, Window.currentRow)))
                .withColumn("__n", F.sum("__bc").over(wk))
                .withColumn("__lo", F.col("__hi") - F.col("__bc")))
    wanted = F.array(*[F.struct(F.lit(name).alias("rname"), fn(F.col("__n")).cast("bigint").alias("r"))
                       for name, fn in ranks.items()])
    need = (hist.select(*K, "__b", "__n", "__lo", "__hi", F.explode(wanted).alias("__t"))
                .select(*K, "__b", "__n", "__lo", F.col("__t.rname").alias("__rname"),
                        F.col("__t.r").alias("__r"))
                .where((F.col("__r") >= F.col("__lo")) & (F.col("__r") < F.col("__hi"))))
    cand = c.join(need, on=K + ["__b"], how="inner")
    wb = Window.partitionBy(*K, "__b", "__rname").orderBy("__v") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cand = (cand.withColumn("__chi", F.col("__lo") + F.sum("__c").over(wb))
                .withColumn("__clo", F.col("__chi") - F.col("__c"))
                .where((F.col("__r") >= F.col("__clo")) & (F.col("__r") < F.col("__chi"))))
    # every group has at least one value, so each wanted rank in [0, n) has a row here
    return cand.groupBy(*K).agg(
        F.max("__n").alias("n"),
        *[F.max(F.when(F.col("__rname") == name, F.col("__v"))).alias(name) for name in ranks])


def exact_quantiles(df: DataFrame, value: str | Column, probs: dict[str, float],
                    keys: Sequence[str] = ()) -> DataFrame:
    """Exact quantiles with linear interpolation between order statistics
    (position (n-1)p), per group of ``keys``; one column per name in
    ``probs``, plus ``n``. Distributed: see module docstring."""
    ranks = {}
    for name, p in probs.items():
        ranks[f"__lo_{name}"] = (lambda n, p=p: F.floor((n - 1) * F.lit(p)))
        ranks[f"__hi_{name}"] = (lambda n, p=p: F.ceil((n - 1) * F.lit(p)))
    vals = values_at_ranks(df, value, ranks, keys)
    out = vals
    for name, p in probs.items():
        pos = (F.col("n") - 1) * F.lit(p)
        lo, hi = F.col(f"__lo_{name}"), F.col(f"__hi_{name}")
        out = out.withColumn(name, lo + (hi - lo) * (pos - F.floor(pos)))
    return out.drop(*ranks.keys())


def top_k_sum(df: DataFrame, value: str, k_of_n: Callable[[Column], Column],
              keys: Sequence[str] = ()) -> DataFrame:
    """Sum of the ``k`` largest values (k a function of the group size n),
    exact with ties: sum(values > t) + (k - count(values > t)) * t where t is
    the k-th largest value. Returns keys, n, k, threshold, top_sum."""
    K = list(keys)
    thr = values_at_ranks(df, value, {"threshold": lambda n: n - k_of_n(n)}, K)
    thr = thr.withColumn("k", k_of_n(F.col("n")).cast("bigint"))
    base = df.select(*K, F.col(value).alias("__v")).where(F.col("__v").isNotNull())
    if K:
        joined = base.join(thr, on=K, how="inner")
    else:
        joined = with_scalars(base, thr)  # one row
    agg = joined.groupBy(*K, "n", "k", "threshold").agg(
        F.sum(F.when(F.col("__v") > F.col("threshold"), F.col("__v"))).alias("__gs"),
        F.count(F.when(F.col("__v") > F.col("threshold"), 1)).alias("__gc"))
    return agg.withColumn("top_sum", F.coalesce(F.col("__gs").cast("double"), F.lit(0.0))
                          + (F.col("k") - F.col("__gc")) * F.col("threshold")) \
              .drop("__gs", "__gc")
