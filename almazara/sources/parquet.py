"""Parquet tables: statistics without reading data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def footer_extremes(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """(rows, min_<name>, max_<name>) by aggregates pushed to Parquet footers. SRC-23, SRC-24.

    The pushdown needs the newer reader and a setting, put on for the planning
    of this aggregate and then put back. Footers know no extremes of texts cut
    off by the writer, nor of nested columns; such columns are scanned.
    """
    keys = ("spark.sql.parquet.aggregatePushdown", "spark.sql.sources.useV1SourceList")
    old = [spark.conf.get(k, None) for k in keys]
    spark.conf.set(keys[0], "true")
    spark.conf.set(keys[1], "")
    try:
        out = spark.read.parquet(path).agg(F.count("*").alias("rows"), *[x for n, c in columns.items() for x in (F.min(c).alias(f"min_{n}"), F.max(c).alias(f"max_{n}"))])
        out._jdf.queryExecution().optimizedPlan()
        return out
    finally:
        for k, v in zip(keys, old):
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
