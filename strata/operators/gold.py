"""Aggregates and rankings over fact ⋈ current dimension.

The fact is aggregated by the join key *before* the join (map-side partial
aggregation, then one shuffle by key). Counts and sums distribute over the
key, so the join and the final grouping then see one row per key instead of
one per fact row, and a key holding a third of all facts is already one row
per map task before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.columns import money


def sums_per(fact: DataFrame, key: str, amount: str, count_col: str, by: Sequence[str] = ()) -> DataFrame:
    """``(*by, key, _n, _amt)``: the fact's ``count(count_col)`` and exact
    ``sum(amount)`` per key. Kept per partition of the fact (``by``, e.g. year and
    month), these sums are mergeable: what depends on all of the fact is made from
    them, and when orders enter, change or leave a month only its rows are made
    anew. A key counts in as many of them as it has months, so it is gone from distinct
    counts when it has left the last one."""
    return fact.groupBy(*by, key).agg(F.count(count_col).alias("_n"), F.sum(money(amount)).alias("_amt"))


def merged_sums(sums: DataFrame, key: str) -> DataFrame:
    """The sums of ``sums_per`` over all its partitions."""
    return sums.groupBy(key).agg(F.sum("_n").alias("_n"), F.sum("_amt").alias("_amt"))


def sales_from(sums: DataFrame, dim: DataFrame, key: str, by: Sequence[str], distinct_key: bool = False,
               as_of: str | None = None, dim_key: str | None = None) -> DataFrame:
    """``sales_by`` from one row of sums per key."""
    pre = sums.select(F.col(key).alias("_k"), "_n", "_amt")
    j = pre.join(dim.select(F.col(dim_key or key).alias("_k"), *by), "_k", "inner")
    aggs = [F.sum("_n").alias("total_orders"), F.sum("_amt").cast("double").alias("total_amount")]
    if distinct_key:
        aggs.append(F.count_distinct("_k").alias("unique_products"))
    out = j.groupBy(*by).agg(*aggs)
    if as_of is not None:
        out = out.withColumn("update_date", F.to_date(F.lit(as_of)))
    return out


def sales_by(fact: DataFrame, dim: DataFrame, key: str, by: Sequence[str], amount: str,
             count_col: str, distinct_key: bool = False, as_of: str | None = None,
             dim_key: str | None = None) -> DataFrame:
    """``count(count_col)`` and exact ``sum(amount)`` of the fact per ``by``
    columns of the (current) dimension, inner-joined on ``key``.

    ``distinct_key`` adds ``unique_products`` (distinct keys per group);
    ``as_of`` adds a fixed ``update_date`` (repeatable, unlike the current date).
    """
    return sales_from(sums_per(fact, key, amount, count_col), dim, key, by, distinct_key, as_of, dim_key)


def spend_from(sums: DataFrame, dim: DataFrame, key: str, attrs: Sequence[str]) -> DataFrame:
    """``spend_per`` from one row of sums per key."""
    j = sums.select(key, "_amt").join(dim.select(key, *attrs), key, "inner")
    return j.select(key, *attrs, F.col("_amt").cast("double").alias("total_amount"))


def spend_per(fact: DataFrame, dim: DataFrame, key: str, attrs: Sequence[str], amount: str) -> DataFrame:
    """Exact total of ``amount`` per dimension key, with its attributes."""
    return spend_from(fact.groupBy(key).agg(F.sum(money(amount)).alias("_amt")), dim, key, attrs)


def rank_top(df: DataFrame, value: str, tie_key: str, n: int, rank_col: str = "ranking") -> DataFrame:
    """Global ``row_number()`` by ``value`` desc (ties: ``tie_key`` asc), top ``n``.

    Written as a filter on the rank, Spark puts a per-partition group limit
    below the window, so only ``n`` rows per partition reach the single
    partition that numbers them; the rest is never sorted globally.
    """
    w = Window.orderBy(F.col(value).desc(), F.col(tie_key).asc())
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)
