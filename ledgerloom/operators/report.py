"""Counts and rates."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def table_counts(tables: Mapping[str, DataFrame], batch_col: str | None = None) -> DataFrame:
    """Rows of each table, by batch if a column names one."""
    if batch_col is None:
        parts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table"), "n") for name, df in tables.items()]
    else:
        parts = [df.groupBy(batch_col).agg(F.count("*").alias("n")).select(F.lit(name).alias("table"), F.col(batch_col).alias("batch"), "n") for name, df in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def run_stats(frames: DataFrame, elapsed_s: float) -> DataFrame:
    """One row: frames, bytes, elapsed seconds and frames a second (elapsed is 0.001 s at least)."""
    s = F.greatest(F.lit(float(elapsed_s)), F.lit(0.001))
    return frames.agg(F.count("*").alias("checkpoints"), F.coalesce(F.sum("length"), F.lit(0)).cast("bigint").alias("total_bytes")).select("checkpoints", "total_bytes", F.lit(float(elapsed_s)).alias("elapsed_s"), (F.col("checkpoints") / s).alias("per_second"))
