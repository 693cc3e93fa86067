"""CSV reader quirks: a UTF-8 byte-order mark, quoted multi-line text,
leading zeros kept by the explicit schema, unparseable values coerced."""

import os
import random
import tempfile
from contextlib import contextmanager
from decimal import Decimal

import pytest

from pyspark.sql import functions as F

from pyspark.sql.types import StringType, StructField, StructType

from marketlens.operators import clean
from marketlens.sources import multiline
from marketlens.sources.readers import SOURCE_FILES, load_raw_csv
from marketlens.sources.schemas import SOURCE_SCHEMAS


def _write(folder, name, text, bom=False):
    path = os.path.join(folder, SOURCE_FILES[name])
    with open(path, "w", encoding="utf-8-sig" if bom else "utf-8", newline="") as f:
        f.write(text)


def test_csv_reader_quirks(spark):
    d = tempfile.mkdtemp(prefix="marketlens-csv-")
    for name, schema in SOURCE_SCHEMAS.items():           # empty tables with headers
        _write(d, name, ",".join(schema.fieldNames()) + "\n")
    _write(d, "translation", "product_category_name,product_category_name_english\n"
                             "beleza_saude,health_beauty\nferramentas,costruction_tools_tools\n", bom=True)
    _write(d, "reviews", "review_id,order_id,review_score,review_comment_title,review_comment_message,"
                         "review_creation_date,review_answer_timestamp\n"
                         'r1,o1,5,,"line one\nline two, with ""quotes""",2018-01-01 10:00:00,2018-01-02 10:00:00\n'
                         "r2,o2,4,,,not-a-date,\n")
    _write(d, "customers", "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
                           "c1,u1,01037,sao paulo,SP\nc2,u2,1037,rio,RJ\n")
    t = load_raw_csv(spark, d)
    tr = t["translation"].collect()
    assert t["translation"].columns == ["product_category_name", "product_category_name_english"]
    assert [r.product_category_name for r in tr] == ["beleza_saude", "ferramentas"]
    fixed = clean.clean_products(spark.createDataFrame([("p1", "ferramentas")], "product_id string, "
                                                       "product_category_name string"), t["translation"])
    assert fixed.collect()[0].product_category_name_english == "construction_tools_tools"
    rv = {r.review_id: r for r in t["reviews"].collect()}
    assert rv["r1"].review_comment_message == 'line one\nline two, with "quotes"'
    assert rv["r2"].review_creation_date is None and rv["r2"].review_score == 4
    zips = [r.z for r in clean.clean_customers(t["customers"]).orderBy("customer_id")
            .select(F.col("customer_zip_code_prefix").alias("z")).collect()]
    assert zips == ["01037", "01037"]


def test_malformed_values_become_null_and_money_keeps_its_scale(spark):
    d = tempfile.mkdtemp(prefix="marketlens-csv-")
    for name, schema in SOURCE_SCHEMAS.items():
        _write(d, name, ",".join(schema.fieldNames()) + "\n")
    _write(d, "items", "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
                       "o1,1,p1,s1,2018-01-01 10:00:00,10.1234,0.0001\no1,2.0,p1,s1,soon,ten,5\no2,1.5,p1,s1,,7, 2.5 \n")
    _write(d, "orders", ",".join(SOURCE_SCHEMAS["orders"].fieldNames()) + "\n"
                        "o1,c1,delivered,2018-01-01 10:00:00,never,,2018-13-45 00:00:00,2018-02-01 00:00:00\n")
    t = load_raw_csv(spark, d)
    items = clean.clean_items(t["items"]).collect()
    assert [(r.order_item_id, r.price, r.freight_value, r.shipping_limit_date is None) for r in items] == [
        (1, Decimal("10.1234"), Decimal("0.0001"), False), (2, None, Decimal("5.0000"), True), (None, Decimal("7.0000"), Decimal("2.5000"), True)]
    o = clean.clean_orders(t["orders"]).collect()[0]
    assert o.order_approved_at is None and o.order_delivered_customer_date is None and o.order_purchase_timestamp.year == 2018


def test_one_file_is_read_in_several_partitions(spark):
    d = tempfile.mkdtemp(prefix="marketlens-csv-")
    for name, schema in SOURCE_SCHEMAS.items():
        _write(d, name, ",".join(schema.fieldNames()) + "\n")
    _write(d, "payments", "order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
           + "".join(f"o{i},1,card,1,{i}.25\n" for i in range(200_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500k")
    try:
        t = load_raw_csv(spark, d)
        assert t["payments"].rdd.getNumPartitions() > 1
        assert t["payments"].count() == 200_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


ABC = StructType([StructField(c, StringType()) for c in "abc"])


@contextmanager
def split_bytes(spark, size):
    """Scans split files into pieces of ``size`` bytes."""
    own = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "32"}
    before = {k: spark.conf.get(k, None) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _unsplit(spark, path):
    df = spark.read.schema(ABC).option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return sorted(map(tuple, df.collect()), key=repr)


def _split(spark, path):
    return sorted(map(tuple, multiline.read_multiline_csv(spark, path, ABC).collect()), key=repr)


def _cell(rnd, stray):
    kind = rnd.random()
    t = "".join(rnd.choices(["a", "é", " ", "x", "\n", '"', ",", "7"], k=rnd.randint(0, 14)))
    if kind < 0.25:
        return ""
    if kind < 0.7:
        return '"' + t.replace('"', '""') + '"'
    t = t.replace("\n", "").replace(",", "")
    return t.lstrip('"') if stray else t.replace('"', "")  # a quote inside an unquoted cell is a letter


@pytest.mark.parametrize("size, eol, stray", [(61, "\n", True), (61, "\r\n", False), (300, "\r\n", True)])
def test_split_csv_equals_the_unsplit_read(spark, size, eol, stray):
    rnd = random.Random(size)
    d = tempfile.mkdtemp(prefix="marketlens-csv-")
    for k in range(2):
        with open(f"{d}/{k}.csv", "w", newline="", encoding="utf-8-sig") as f:
            f.write("a,b,c" + eol + "".join(",".join(_cell(rnd, stray) for _ in range(3)) + eol for _ in range(60)))
    with split_bytes(spark, size):
        assert spark.read.text(d).rdd.getNumPartitions() > 8
        assert _split(spark, d) == _unsplit(spark, d)


def test_split_csv_edges(spark, monkeypatch):
    long = "line one\nline \"\"two\"\",\n" * 300    # over many splits
    files = {"header": "a,b,c", "header_eol": "a,b,c\n", "no_last_eol": "a,b,c\n1,2,3\n4,\"5\n5\",6",
             "blank": "a,b,c\n\n1,2,3\n   \n\n4,5,6\n", "long": f'a,b,c\n1,"{long}",3\n4,5,6\n7,"{long}","{long}"\n',
             "short": "a,b,c\n1\n1,2\n1,2,3,4\n", "open": 'a,b,c\n1,2,3\n4,"5\n6,7,8', "quoted": 'a,b,c\n"","x ""y""","\n"\n"a"b,"c" d,e"f\n'}
    d = tempfile.mkdtemp(prefix="marketlens-csv-")
    for name, text in files.items():
        with open(f"{d}/{name}.csv", "w", newline="", encoding="utf-8") as f:
            f.write(text)
    want = _unsplit(spark, d)
    for bound in (multiline.BROADCAST, -1):   # states broadcast, and joined by a shuffle
        monkeypatch.setattr(multiline, "BROADCAST", bound)
        with split_bytes(spark, 128):
            assert _split(spark, d) == want
