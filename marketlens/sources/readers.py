"""Source readers. CSV files are read as text by explicit schemas and coerced:
a malformed number or date becomes null, the rest of its row stays. All files
are split into many tasks, also that of the reviews, whose quoted texts hold line
breaks (``multiline``). The readers drop a UTF-8 byte-order mark."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.coerce import coerce
from .multiline import read_multiline_csv
from .schemas import SOURCE_SCHEMAS

# Default file of each table: ``<table>.csv`` in the raw folder. Real exports
# with other names are read by passing ``files={table: file_name}``.
SOURCE_FILES = {name: f"{name}.csv" for name in SOURCE_SCHEMAS}

#: Tables whose quoted text holds line breaks.
MULTI_LINE = {"reviews"}


def load_raw_csv(spark: SparkSession, raw_dir: str, files: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """The nine raw tables from CSV (header row, UTF-8). ``files`` maps table
    names to file (or folder) names inside ``raw_dir``. Tables with line breaks
    in their texts are scanned once now, all rows when they are used."""
    mapping = dict(SOURCE_FILES, **(files or {}))
    out = {}
    for name, fname in mapping.items():
        schema = SOURCE_SCHEMAS[name]
        path = os.path.join(raw_dir, fname)
        text = StructType([StructField(f.name, StringType(), True) for f in schema.fields])
        if name in MULTI_LINE:
            df = read_multiline_csv(spark, path, schema)
        else:
            df = spark.read.schema(text).option("header", True).option("escape", '"').option("mode", "PERMISSIVE").csv(path)
        out[name] = df.select(*[coerce(f.name, f.dataType).alias(f.name) for f in schema.fields])
    return out


def read_testdata(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
