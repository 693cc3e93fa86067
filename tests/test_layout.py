"""The facts are laid out by order: groups and joins on it need no exchange."""

from pyspark.sql import functions as F

from marketlens.operators import facts
from marketlens.plans.context import get_context

SF = "/root/testdata/sf0.001"


def _plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_facts_by_order_need_no_exchange(spark):
    ctx = get_context(spark, SF)
    full, master, items = ctx.full, ctx.master, ctx.items
    for df in (facts.first_item_category(full), facts.order_seller_pairs(full), facts.items_per_order(items)):
        assert "Exchange" not in _plan(df)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = master.select("order_id", "order_value").join(items.groupBy("order_id").agg(F.sum("price").alias("p")), "order_id")
        plan = _plan(joined)
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # two columns of the fact are two columns of the scan
    assert "ReadSchema: struct<order_id:bigint,order_value:" in _plan(master.select("order_id", "order_value"))


def test_tables_go_with_their_context(spark):
    from marketlens.plans.context import MarketContext
    ctx = MarketContext(spark, SF)
    rows = ctx.items.count()
    name = ctx._tables[0]
    assert spark.catalog.tableExists(name) and rows > 0
    ctx.release()
    assert not spark.catalog.tableExists(name)


def test_items_are_written_without_their_order(spark, monkeypatch):
    """The item-level fact of many items repeats no column of its order on disk."""
    from marketlens.plans import context
    want = get_context(spark, SF).full
    monkeypatch.setattr(context, "FEW_ITEMS", 0)
    ctx = context.MarketContext(spark, SF)
    assert ctx.full.exceptAll(want).isEmpty() and ctx.full.count() == want.count()
    assert "Exchange" not in _plan(facts.first_item_category(ctx.full))
    wide = [t for t in ctx._tables if {"order_status", "seller_state"} <= set(spark.table(t).columns)]
    assert wide == []


def test_a_model_is_fitted_when_read(spark):
    from marketlens.operators import ml
    ctx = get_context(spark, SF)
    tm = ml.train_models(ctx.ml_dataset, num_trees=2, max_depth=2)
    assert ml.lr_coefficients(spark, tm).count() > 0 and "rf" not in tm.__dict__
    assert ml.risk_bands(tm.rf_scored).count() > 0 and "lr_scored" not in tm.__dict__


def test_partitions_of_the_facts_follow_the_items(spark, monkeypatch):
    """More items: more buckets, so that a task's rows fit its memory; same rows,
    payments without an order included."""
    from marketlens.plans import context
    own = int(spark.conf.get("spark.sql.shuffle.partitions"))
    raw = dict(context.MarketContext(spark, SF).raw)
    lost = raw["payments"].limit(3).withColumn("order_id", F.lit(None).cast("bigint"))
    raw["payments"] = raw["payments"].unionByName(lost)
    few = context.MarketContext(spark, raw=raw, spelling_fixes=context.FIXTURE_SPELLING_FIXES)
    want, paid = few.master, few.payments_agg
    assert few.partitions == own and spark.conf.get(context.INITIAL_PARTITIONS, None) is None
    monkeypatch.setattr(context, "ITEMS_EACH", 250)
    ctx = context.MarketContext(spark, raw=raw, spelling_fixes=context.FIXTURE_SPELLING_FIXES)
    try:
        rows = ctx.master
        assert ctx.partitions > own and spark.conf.get(context.INITIAL_PARTITIONS) == str(ctx.partitions)
        buckets = {r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {ctx._tables[-1]}").where("col_name = 'Num Buckets'").collect()}
        assert buckets == {str(ctx.partitions)}
        assert rows.exceptAll(want).isEmpty() and rows.count() == want.count()
        assert ctx.payments_agg.exceptAll(paid).isEmpty() and ctx.payments_agg.where("order_id is null").count() == 1
        assert "Exchange" not in _plan(facts.items_per_order(ctx.items))
        assert ctx.full.exceptAll(few.full).isEmpty() and ctx.full.columns == few.full.columns
        attributes = ctx.item_attributes
        monkeypatch.setattr(context, "FEW_SELLERS", 0)
        del ctx.__dict__["item_attributes"]
        assert ctx.item_attributes.exceptAll(attributes).isEmpty() and ctx.item_attributes.count() == attributes.count()
    finally:
        ctx.release()
        few.release()
    assert spark.conf.get(context.INITIAL_PARTITIONS, None) is None


def test_a_fit_has_tasks_for_the_cores(spark, monkeypatch):
    """However many partitions the facts have: every task of a fit sends all nodes'
    statistics. All rows are fitted, and a task has FIT_ROWS rows at most."""
    from marketlens.operators import ml
    ds = get_context(spark, SF).ml_dataset.repartition(40, "order_id")
    own = ml.FIT_TASKS_A_CORE * spark.sparkContext.defaultParallelism
    tm = ml.train_models(ds, num_trees=2, max_depth=2)
    assert tm.train_features.rdd.getNumPartitions() > own == tm.fit_tasks
    seen = []
    fit = ml.LogisticRegression.fit

    def spied(self, rows):
        seen.append((rows.rdd.getNumPartitions(), rows.count()))
        return fit(self, rows)

    monkeypatch.setattr(ml.LogisticRegression, "fit", spied)
    assert tm.lr is not None and seen == [(own, tm.train.count())]
    monkeypatch.setattr(ml, "FIT_ROWS", 10)
    assert ml.fit_tasks(spark, 1_001) == 101


def test_first_items_and_seller_pairs_join_without_exchange(spark):
    ctx = get_context(spark, SF)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (ctx.first_cat, ctx.order_sellers):
            plan = _plan(df.join(ctx.master.select("order_id", "review_score"), "order_id", "left"))
            assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_only_keys_of_many_items_go_to_the_products(spark, monkeypatch):
    """Same rows as the plain joins, items without a product, products that come
    twice and items that come twice included."""
    from marketlens.plans import context
    raw = dict(context.MarketContext(spark, SF).raw)
    some = raw["items"].where("order_item_id = 1")
    raw["items"] = raw["items"].unionByName(some).unionByName(some.withColumn("product_id", F.lit(None).cast("bigint")))
    raw["products"] = raw["products"].unionByName(raw["products"].where("product_id % 5 = 0").withColumn("product_weight_g", F.lit(1.5)))
    want = context.MarketContext(spark, raw=raw, materialize="none").full
    monkeypatch.setattr(context, "ITEMS_EACH", 250)
    monkeypatch.setattr(context, "FEW_ITEMS", 0)
    sent, join = [], facts.with_products
    monkeypatch.setattr(context.facts, "with_products", lambda df, p: sent.append(df.columns) or join(df, p))
    ctx = context.MarketContext(spark, raw=raw)
    before = spark.conf.get(context.CO_PARTITION)
    try:
        got = ctx.full
        assert sent[0] == ["order_id", "product_id"] and spark.conf.get(context.CO_PARTITION) == before
        assert got.columns == want.columns and got.count() == want.count()
        assert got.exceptAll(want).isEmpty() and want.where("product_id is null and price is not null").count() > 0
    finally:
        ctx.release()


def test_node_ids_are_kept_only_where_they_fit(spark, monkeypatch):
    """A forest of more rows than memory holds keeps no node ids, which would go to
    disk; it is the same forest."""
    from marketlens.operators import ml
    ds = get_context(spark, SF).ml_dataset

    def fitted():
        tm = ml.train_models(ds, num_trees=4, max_depth=4)
        return tm.estimators["rf"].getCacheNodeIds(), tm.rf.stages[-1].toDebugString.split("\n")[1:], tm.train.count()

    kept, trees, rows = fitted()
    assert kept and rows > 0
    a_row = 4 * 4 * 4 + 512   # draws and three generations of ids in four trees, and the row
    monkeypatch.setattr(ml, "storage_memory", lambda _: 2 * rows * a_row)
    assert fitted() == (True, trees, rows)
    monkeypatch.setattr(ml, "storage_memory", lambda _: 2 * rows * a_row - 2)
    assert fitted() == (False, trees, rows)


def test_storage_is_the_executors(spark):
    """A local master has one store; on a cluster the driver's is not counted."""
    from types import SimpleNamespace as N

    from marketlens.session import storage_memory
    one = storage_memory(spark)
    heap = spark.sparkContext._jvm.java.lang.Runtime.getRuntime().maxMemory()
    assert 0 < one < heap

    def cluster(sizes):
        names = iter(sizes)
        left = list(sizes)
        status = N(keysIterator=lambda: N(hasNext=lambda: bool(left), next=lambda: (left.pop(), next(names))[1]),
                   apply=lambda n: N(_1=lambda: sizes[n]))
        manager = N(blockManagerId=lambda: N(hostPort=lambda: "driver:1"))
        env = N(get=lambda: N(blockManager=lambda: manager))
        jvm = N(org=N(apache=N(spark=N(SparkEnv=env))))
        return N(sparkContext=N(_jsc=N(sc=lambda: N(getExecutorMemoryStatus=lambda: status)), _jvm=jvm))

    assert storage_memory(cluster({"driver:1": 7, "a:1": 5, "a:2": 6})) == 11
    assert storage_memory(cluster({"driver:1": 7})) == 7


def test_a_fact_leaves_no_shuffle_files(spark):
    """They go when the fact is written, not when the driver's heap is next collected."""
    import time

    from marketlens.plans import context
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        found = blocks.getAllFiles()
        names = (found.apply(k).getName() for k in range(found.size()))
        return {n for n in names if n.startswith("shuffle_")}

    ctx = context.MarketContext(spark, SF)
    conf = spark.conf.get(context.DROP_SHUFFLES)
    own, before = ctx.partitions, files()   # the count of the items is no fact
    try:
        assert own and ctx.master.count() > 0
        for _ in range(100):
            if len(left := {n for n in files() - before if n.endswith(".data")}) <= 1:   # that of the count above
                break
            time.sleep(0.2)
        assert len({n.split("_")[1] for n in left}) <= 1, left
        assert spark.conf.get(context.DROP_SHUFFLES) == conf
        assert ctx.master.count() == ctx.orders.count()
    finally:
        ctx.release()
