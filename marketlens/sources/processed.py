"""The processed facts, read back for the phases after their writing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .manifest import read_table


def load_orders(spark: SparkSession, root: str, schema: StructType | None = None, first_month: str | None = None,
                last_month: str | None = None, table: str = "orders_master") -> DataFrame:
    """The order fact of the current set, of the months asked for (labels
    YYYY-MM, both inclusive; None: open). Only their folders are read."""
    df = read_table(spark, root, table, schema)
    if first_month is not None:
        df = df.where(F.col("purchase_month_label") >= first_month)
    if last_month is not None:
        df = df.where(F.col("purchase_month_label") <= last_month)
    return df


def load_processed(spark: SparkSession, root: str, schema: StructType | None = None, first_month: str | None = None,
                   last_month: str | None = None) -> DataFrame:
    """The delivered scope of the processed orders."""
    return load_orders(spark, root, schema, first_month, last_month).where(F.col("order_status") == "delivered")
