"""Batch scans of the parquet tables of one directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Scan <root>/<name>.parquet; zone-less timestamps are read as UTC instants."""
    df = spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")
    zoneless = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in zoneless}) if zoneless else df
