"""Sets of tables that change as a whole.

A write puts its tables into a folder of its own, where nobody looks yet, and
then commits a manifest: one small file that says, for each table and each of its
partitions, which folder holds it. Readers go by the newest manifest, so they see
all of a write or nothing of it; a driver lost in between leaves the former set
as it was. A table written again by partition replaces the partitions that the
write holds; the others stay where the manifest before says they are.

    root/data/<commit>/<table>/...      tables, possibly by partition
    root/manifest/version=<n>/*.json    one file a commit

One writer at a time. Former versions stay readable (``version=``).
"""

from __future__ import annotations

import json
import os
import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

ENTRY = "table string, part string, path string, format string, part_by string, row_count long, schema string"


def manifests(spark: SparkSession, root: str) -> DataFrame | None:
    """All entries of all committed versions; None before the first commit."""
    try:
        return spark.read.schema(ENTRY + ", version int").json(os.path.join(root, "manifest"))
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def entries(spark: SparkSession, root: str, version: int | None = None) -> tuple[int, list]:
    """The newest version (or the one asked for) and its entries: one a table and partition."""
    found = manifests(spark, root)
    if found is None:
        return 0, []
    if version is None:
        version = found.agg(F.max("version")).first()[0] or 0
    return version, found.where(F.col("version") == version).drop("version").collect()


def _write(df: DataFrame, path: str, fmt: str, part_by: str | None) -> None:
    w = df.write.mode("errorifexists")
    if part_by:
        w = w.partitionBy(part_by)
    if fmt == "csv":
        w = w.option("header", True)
    w.format(fmt).save(path)


def _read(spark: SparkSession, entry_schema: str, fmt: str) -> "object":
    r = spark.read.schema(StructType.fromJson(json.loads(entry_schema))).format(fmt)
    return r.option("header", True) if fmt == "csv" else r


def commit(spark: SparkSession, root: str, tables: dict[str, DataFrame], fmt: str = "parquet",
           partition_by: dict[str, str] | None = None, replace_parts: bool = False) -> dict[str, str]:
    """Write ``tables`` and make them the current ones, all at once; tables of the
    set that are not named stay. With ``replace_parts`` a partitioned table keeps
    the partitions that this write has no rows for. Returns the folders."""
    folder = f"{root.rstrip('/')}/data/{uuid.uuid4().hex}"
    version, before = entries(spark, root)
    new = []
    for name, df in tables.items():
        part_by = (partition_by or {}).get(name)
        path, schema = f"{folder}/{name}", df.schema.json()
        _write(df, path, fmt, part_by)
        if part_by:
            back = _read(spark, schema, fmt).load(path)
            parts = back.groupBy(F.col(part_by).cast("string").alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()  # one row a partition
            new += [(name, r["part"], path, fmt, part_by, r["n"], schema) for r in parts]
            if replace_parts:
                own = {r["part"] for r in parts}
                new += [tuple(e) for e in before if e["table"] == name and e["part_by"] == part_by and e["part"] not in own and e["row_count"]]
            if not any(e[0] == name for e in new):
                new.append((name, None, path, fmt, part_by, 0, schema))
        else:
            new.append((name, None, path, fmt, None, None, schema))
    new += [tuple(e) for e in before if e["table"] not in tables]
    # one file, which appears when the job commits: this is the moment of the change
    spark.createDataFrame(new, ENTRY).withColumn("version", F.lit(version + 1)).coalesce(1).write.mode("append").partitionBy("version").json(
        os.path.join(root, "manifest"))
    return {name: f"{folder}/{name}" for name in tables}


def read_table(spark: SparkSession, root: str, table: str, schema: StructType | None = None, version: int | None = None) -> DataFrame:
    """A table of the current set. ``schema``: names and types it must have. A
    filter on its partition column reads the folders of these partitions only."""
    own = [e for e in entries(spark, root, version)[1] if e["table"] == table]
    if not own:
        raise LookupError(f"{root} has no table {table!r}")
    if schema is not None:
        want = {f.name: f.dataType for f in schema.fields}
        for stored in {e["schema"] for e in own}:
            got = {f.name: f.dataType for f in StructType.fromJson(json.loads(stored)).fields}
            if got != want:
                wrong = sorted(k for k in {*got, *want} if got.get(k) != want.get(k))
                raise ValueError(f"{table!r} in {root} is not as expected in {wrong}")
    columns = StructType.fromJson(json.loads(own[0]["schema"])).fieldNames()
    parts = []
    for path in sorted({e["path"] for e in own}):
        here = [e for e in own if e["path"] == path]
        df = _read(spark, here[0]["schema"], here[0]["format"]).load(path)
        by = here[0]["part_by"]
        if by and len({e["path"] for e in own}) > 1:  # other partitions of this folder have been replaced
            named = [e["part"] for e in here if e["part"] is not None]
            keep = F.col(by).cast("string").isin(named)
            if len(named) < len(here):
                keep = keep | F.col(by).isNull()
            df = df.where(keep)
        parts.append(df.select(*[F.col(f"`{c}`") for c in columns]))
    return reduce(lambda a, b: a.unionByName(b), parts)
