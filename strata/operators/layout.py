"""Physical layout jobs: compaction, clustering, partitioned writes.

``compact`` rewrites a table into fewer, larger files, optionally clustered:
one column -> range partitioning + sort; two or more -> an interleaved-bit
(Morton) key over per-column range buckets, so rows close in every column
share files and Parquet min/max statistics skip more. Bucket bounds come from
``percentile_approx`` (one small aggregate row) or, for strings, from range
partitioning the distinct values, never from a global sort or ``ntile`` (which
needs a single partition).

No file count is fixed: shuffles without a number of partitions are cut by AQE
to ``spark.sql.adaptive.advisoryPartitionSizeInBytes``, so the number of files
follows the data. Output always goes to a new path: a table is never
overwritten by a plan that reads it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _range_bucket(c: Column, bounds: Sequence) -> Column:
    # number of bounds <= value: 0 .. len(bounds)
    return sum((F.when(c >= F.lit(b), 1).otherwise(0) for b in bounds), F.lit(0))


def _bounds(df: DataFrame, cols: Sequence[str], n: int) -> dict[str, list]:
    """For each column up to ``n - 1`` ascending values that cut it into about
    equal parts: of its rows, or (strings, compared whole) of its distinct values."""
    types = dict(df.dtypes)
    probs = [i / n for i in range(1, n)]
    numbers = {c: F.col(c).cast("int") if types[c] == "boolean" else F.col(c) for c in cols if types[c] != "string"}
    out: dict[str, list] = {}
    if numbers:
        row = df.agg(*[F.percentile_approx(x, probs, 1000).alias(c) for c, x in numbers.items()]).first()
        out |= {c: sorted(set(row[c] or [])) for c in numbers}
    for c in cols:
        if types[c] == "string":
            parts = df.select(F.col(c).alias("v")).filter("v IS NOT NULL").distinct().repartitionByRange(n, "v")
            lows = parts.groupBy(F.spark_partition_id().alias("p")).agg(F.min("v").alias("low")).collect()
            out[c] = sorted((r["low"] for r in lows), key=lambda v: v.encode())[1:]
    return out


def zorder_key(df: DataFrame, cols: Sequence[str], bits: int = 4) -> Column:
    """Morton key over ``2**bits`` range buckets per column."""
    bounds = _bounds(df, cols, 2 ** bits)
    values = {c: F.col(c).cast("int") if t == "boolean" else F.col(c) for c, t in df.dtypes if c in cols}
    buckets = [_range_bucket(values[c], bounds[c]) for c in cols]
    key = F.lit(0).cast("long")
    for bit in range(bits):
        for i, b in enumerate(buckets):
            shifted = F.shiftleft(F.shiftright(b, bit).bitwiseAND(1).cast("long"), bit * len(cols) + i)
            key = key.bitwiseOR(shifted)
    return key


def compact(df: DataFrame, path: str, by: Sequence[str] = (), files: int | None = None,
            partition_by: Sequence[str] = (), bits: int = 4) -> None:
    """Rewrite ``df`` to ``path`` as fewer files, clustered by ``by``. Same rows.

    The number of files follows the data's size (``files`` fixes it instead, of
    an unpartitioned table); a partitioned table's rows are brought together by
    partition first, and only large partitions are cut into several files.
    """
    key = "_cluster"
    if len(by) >= 2:
        df, order = df.withColumn(key, zorder_key(df, by, bits)), [key]
    else:
        order = list(by)
    if partition_by:
        out = df.hint("rebalance", *partition_by).sortWithinPartitions(*partition_by, *order)
    elif order:
        # A row hash as the last range column splits a value that holds a large
        # share of the rows over several ranges (deterministic, so a retried task
        # sends every row to the same place).
        ranged = [*order, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])]
        out = (df.repartitionByRange(files, *ranged) if files else df.repartitionByRange(*ranged)).sortWithinPartitions(*order)
    else:
        out = df.repartition(files) if files else df.hint("rebalance")
    w = out.drop(key).write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_partitioned(df: DataFrame, path: str, cols: Sequence[str], dynamic: bool = False,
                      gather: bool = False) -> None:
    """Partitioned overwrite. ``dynamic`` replaces only the partitions present
    in ``df`` (an incremental refresh); a full rebuild uses static overwrite
    so that a partition that became empty is cleared too.

    By default there is no shuffle: every upstream task writes its own rows
    (no skew, no extra stage). ``gather`` brings a partition's rows together
    first (few files each); AQE cuts one that holds a large share of the rows,
    so it is never written by a single task."""
    out = df.hint("rebalance", *cols) if gather else df
    (out.write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
     .partitionBy(*cols).parquet(path))


def write_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Writes ``df`` as the table ``table`` at ``path``, bucketed and sorted by
    ``keys``, and returns it. Tables with the same number of buckets of the same
    keys join, and are grouped, without a shuffle of either.

    One shuffle here (each bucket one file) saves one in every later join. A key
    that holds a large share of the rows makes its bucket as large; such facts are
    better joined by ``joins`` (which pre-aggregates or splits them).
    """
    spaced = df.repartition(buckets, *keys)
    (spaced.write.mode("overwrite").option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table))
    return df.sparkSession.table(table)
