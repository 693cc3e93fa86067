"""Sinks: marts as Parquet (or CSV) committed as a set, small result frames as JSON, fitted
models through the ML writer."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .manifest import commit


def write_marts(marts: dict[str, DataFrame], out_dir: str, fmt: str = "parquet",
                partition_by: dict[str, str] | None = None, replace_parts: bool = False) -> list[str]:
    """Write the marts as one commit of the set in ``out_dir`` (``manifest``):
    readers see all of them or the former ones. Facts may be partitioned (e.g. by
    month label) so monthly filters prune files, and with ``replace_parts`` only
    the months written are replaced. Returns the folders, named like the marts."""
    if not marts:
        return []
    spark = next(iter(marts.values())).sparkSession
    return list(commit(spark, out_dir, marts, fmt, partition_by, replace_parts).values())


def write_json(df: DataFrame, path: str) -> str:
    """Few-row frames only (KPI row, overview, insight records: bounded by
    construction) as one JSON-lines file; large frames go through write_marts."""
    df.coalesce(1).write.mode("overwrite").json(path)
    return path


def write_model(model, path: str) -> str:
    model.write().overwrite().save(path)
    return path
