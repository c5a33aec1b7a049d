"""All registered queries of the core."""

from __future__ import annotations

from kinelake.operators import anomalies, compaction, imputation
from kinelake.plans import conversion_queries, frame_queries, series_queries

MODULES = [compaction, anomalies, imputation, series_queries, frame_queries, conversion_queries]


def entry(spark, root):
    return series_queries.s3_band_prefix(spark, root)


def queries():
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracle_sql():
    return {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
