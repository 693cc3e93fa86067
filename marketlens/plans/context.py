"""A dataset context: the nine source tables, their cleaned forms and the
fact tables, each defined once and materialised at most once.

Materialisation: ``checkpoint`` (the default, on any master) writes the facts
to the shared ``spark.checkpoint.dir``, items and orders bucketed by order, and
cuts the lineage; ``persist`` keeps
them in executor memory/disk (lost blocks are recomputed from lineage);
``none`` keeps everything lazy.
"""

from __future__ import annotations

import math
import uuid
from contextlib import contextmanager
from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean, facts, marts
from ..session import ensure_checkpoint_dir
from ..sources.fixtures import FIXTURE_SPELLING_FIXES, fixture_tables

FEW_ITEMS = 500_000
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
CO_PARTITION = "spark.sql.requireAllClusterKeysForCoPartition"
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"   # at the end of a write
FEW_SELLERS = 500_000   # are broadcast
ITEMS_EACH = 250_000    # of a bucket, so that a task sorts its rows in memory


class MarketContext:
    def __init__(self, spark: SparkSession, sf_dir: str | None = None,
                 raw: dict[str, DataFrame] | None = None, spelling_fixes: dict | None = None,
                 materialize: str = "checkpoint"):
        if materialize not in ("checkpoint", "persist", "none"):
            raise ValueError(f"unknown materialisation {materialize!r}")
        if raw is None and sf_dir is None:
            raise ValueError("need sf_dir (testdata fixtures) or raw tables")
        self.spark = spark
        self.sf_dir = sf_dir
        self._raw = raw
        self.spelling_fixes = (FIXTURE_SPELLING_FIXES if raw is None else None) \
            if spelling_fixes is None else spelling_fixes
        self.materialize = materialize
        self._held: list[DataFrame] = []
        self._tables: list[str] = []
        self.cache: dict = {}

    # ---- materialisation -------------------------------------------------
    def _keep(self, df: DataFrame) -> DataFrame:
        if self.materialize == "persist":
            df = df.persist(StorageLevel.MEMORY_AND_DISK)
            self._held.append(df)
        elif self.materialize == "checkpoint":
            ensure_checkpoint_dir(self.spark)
            df = df.checkpoint(eager=True)
        return df

    def _keep_bucketed(self, df: DataFrame, key: str = "order_id") -> DataFrame:
        """As a Parquet table bucketed by ``key`` under ``spark.checkpoint.dir``:
        later joins and groups on the key need no exchange, and readers take only
        the columns they use. Other modes keep as ``_keep`` does."""
        if self.materialize != "checkpoint":
            return self._keep(df)
        name = f"marketlens_{uuid.uuid4().hex}"
        writer = df.write.format("parquet")
        if self.many:
            writer = writer.option("compression", "zstd")
        # else a shuffle's files stay until the driver's heap is next collected
        with self._conf(DROP_SHUFFLES, "true"):
            (writer.option("path", f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/facts/{name}")
             .bucketBy(self.partitions, key).sortBy(key).saveAsTable(name))
        self._tables.append(name)
        return self.spark.table(name)

    @cached_property
    def partitions(self) -> int:
        """Buckets of the facts: they follow the items, at least the session's
        partitions. Beyond these, exchanges start with as many, too; adaptive
        execution joins the small ones."""
        own = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        wanted = math.ceil(self.raw["items"].select("order_id").count() / ITEMS_EACH)
        if wanted > own:
            self.spark.conf.set(INITIAL_PARTITIONS, str(wanted))
        return max(own, wanted)

    @contextmanager
    def _conf(self, name: str, value: str):
        before = self.spark.conf.get(name)
        self.spark.conf.set(name, value)
        try:
            yield
        finally:
            self.spark.conf.set(name, before)

    @property
    def many(self) -> bool:
        return self.partitions > int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def _keep_eager(self, df: DataFrame) -> DataFrame:
        """Materialise now and cut the lineage: a reliable checkpoint in the
        shared ``spark.checkpoint.dir``."""
        ensure_checkpoint_dir(self.spark)
        return df.checkpoint(eager=True)

    def release(self) -> None:
        for df in self._held:
            df.unpersist()
        self._held.clear()
        for name in self._tables:  # the catalogue's entry; the files stay where checkpoints do
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self._tables.clear()
        self.cache.clear()
        if "models" in self.__dict__:
            self.models.release()
        if "split" in self.__dict__:
            self.split[2].unpersist()
        if "partitions" in self.__dict__:
            self.spark.conf.unset(INITIAL_PARTITIONS)
        for name in [n for n, v in type(self).__dict__.items() if isinstance(v, cached_property)]:
            self.__dict__.pop(name, None)

    # ---- sources ---------------------------------------------------------
    @cached_property
    def raw(self) -> dict[str, DataFrame]:
        return self._raw if self._raw is not None else fixture_tables(self.spark, self.sf_dir)

    @cached_property
    def customers(self) -> DataFrame:
        return clean.clean_customers(self.raw["customers"])

    @cached_property
    def orders(self) -> DataFrame:
        return clean.clean_orders(self.raw["orders"])

    @cached_property
    def items(self) -> DataFrame:
        # dealt by order once; the facts and their roll-ups then find the order's items in one bucket
        return self._keep_bucketed(clean.clean_items(self.raw["items"]).repartition(self.partitions, "order_id"))

    @cached_property
    def payments_agg(self) -> DataFrame:
        return clean.payments_per_order(self.raw["payments"])

    @cached_property
    def reviews_agg(self) -> DataFrame:
        return clean.reviews_latest_per_order(self.raw["reviews"])

    @cached_property
    def products(self) -> DataFrame:
        return clean.clean_products(self.raw["products"], self.raw["translation"], self.spelling_fixes)

    @cached_property
    def sellers(self) -> DataFrame:
        return clean.clean_sellers(self.raw["sellers"])

    @cached_property
    def geolocation(self) -> DataFrame:
        return clean.geolocation_by_zip(self.raw["geolocation"])

    # ---- facts -----------------------------------------------------------
    @cached_property
    def master(self) -> DataFrame:
        payments = self.payments_agg
        if self.many:
            # dealt by order once, with no table of nearly all orders on the map side; those
            # without an order meet none
            known = self.raw["payments"].where(F.col("order_id").isNotNull())
            payments = clean.payments_per_order(known.repartition(self.partitions, "order_id"))
        return self._keep_bucketed(facts.orders_master(self.orders, self.customers, payments,
                                                       self.reviews_agg, self.items))

    @cached_property
    def item_attributes(self) -> DataFrame:
        if self.many and self.materialize == "checkpoint" and self.sellers.count() <= FEW_SELLERS:
            # the items lie by order: only their keys go to the products and back, and
            # neither the items nor the sellers' columns through an exchange
            keys = self.items.select("order_id", "product_id").dropna().distinct()
            dealt = facts.with_products(keys, self.products).repartition(self.partitions, "order_id")
            found = self.items.join(dealt.hint("merge"), ["order_id", "product_id"], "left") \
                .select(*facts.with_products(self.items, self.products).columns)
            with self._conf(CO_PARTITION, "false"):   # the buckets by order serve a join on order and product
                return self._keep_bucketed(facts.with_sellers(found, F.broadcast(self.sellers)))
        df = facts.item_attributes(self.items, self.products, self.sellers)
        return self._keep_bucketed(df.repartition(self.partitions, "order_id"))

    @cached_property
    def full(self) -> DataFrame:
        # joined by bucket where it is read: a reader takes only its columns of both
        # sides. Few items are written joined: readers then broadcast what they need
        df = facts.orders_with_items(self.master, self.item_attributes)
        return self._keep_bucketed(df) if self.item_attributes.count() <= FEW_ITEMS else df

    @cached_property
    def delivered(self) -> DataFrame:
        return marts.delivered(self.master)

    @cached_property
    def del_valid(self) -> DataFrame:
        return marts.del_valid(self.master)

    @cached_property
    def first_cat(self) -> DataFrame:
        return self._keep_bucketed(facts.first_item_category(self.full))

    @cached_property
    def order_sellers(self) -> DataFrame:
        return self._keep_bucketed(facts.order_seller_pairs(self.full))

    @cached_property
    def rfm(self) -> DataFrame:
        from ..operators import rfm
        return self._keep(rfm.customer_rfm(self.master))


    # ---- ML --------------------------------------------------------------
    @cached_property
    def ml_dataset(self) -> DataFrame:
        from ..operators import ml
        return self._keep(ml.ml_dataset(self.master, self.full))

    @cached_property
    def split(self):
        from ..operators import ml
        return ml.time_split(ml._cast_numeric(self.ml_dataset))

    @cached_property
    def models(self):
        from ..operators import ml
        return ml.train_models(self.ml_dataset)


_LATEST: dict[tuple, MarketContext] = {}


def get_context(spark: SparkSession, sf_dir: str, materialize: str = "checkpoint") -> MarketContext:
    """The context of a session and dataset, so that several queries share the
    facts. Only the latest one is kept: asking for another dataset releases it."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), materialize)
    ctx = _LATEST.get(key)
    if ctx is None:
        for (app, *_), old in _LATEST.items():
            if app == spark.sparkContext.applicationId:
                old.release()
        _LATEST.clear()
        ctx = _LATEST[key] = MarketContext(spark, sf_dir, materialize=materialize)
    return ctx
