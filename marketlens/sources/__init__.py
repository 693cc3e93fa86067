"""Readers and writers: the nine marketplace source tables (CSV with explicit
schemas, or fixtures derived from the Parquet testdata) and the sinks."""

from .schemas import SOURCE_SCHEMAS, SOURCE_TABLES
from .readers import load_raw_csv, read_testdata
from .fixtures import fixture_tables, FIXTURE_SPELLING_FIXES
from .sinks import write_marts, write_json, write_model

__all__ = ["SOURCE_SCHEMAS", "SOURCE_TABLES", "load_raw_csv",
           "read_testdata", "fixture_tables", "FIXTURE_SPELLING_FIXES",
           "write_marts", "write_json", "write_model"]
