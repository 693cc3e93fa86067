"""marketlens: marketplace order analytics expressed as Spark DataFrame plans.

Layout
------
sources/    readers for the nine marketplace tables (CSV with explicit schemas,
            Parquet) and the deterministic fixtures derived from the testdata;
            sinks for marts, JSON and fitted models.
functions/  column-expression helpers (floor-day differences, right-closed
            buckets, zero-padding, safe ratios, display labels).
operators/  the analytics: cleaning, fact tables, RFM, marts, delivery and
            satisfaction analyses, quality checks, ML, insight rules, serving.
plans/      wiring: a per-dataset context that builds and reuses the facts,
            the query registry and the output contracts used by the SQL oracle.
"""

__version__ = "0.1.0"
