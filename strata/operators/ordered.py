"""Positions of rows in a global order, without a single-partition sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import scratch_dir

#: ``monotonically_increasing_id`` holds the partition above this many bits.
_LOCAL_BITS = 33


def with_positions(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """``df`` sorted by ``order`` (which must be total) with positions from 1.

    The sort is a range-partitioned one; rows are numbered within their range
    and written, and each range's start is the number of rows in the ranges
    before it, a sum over one row per range."""
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, "ordered")
    df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    rows = rows.withColumn("_part", F.shiftright("_at", _LOCAL_BITS))
    parts = rows.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = rows.join(parts.select("_part", before.alias("_before")), "_part")
    local = F.col("_at").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    return placed.select(*df.columns, (F.col("_before") + local + 1).alias(name))
