"""Integrity checks on the layered tables. Each returns the offending rows
(empty = pass), so a check is just another distributed query."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from strata.functions.columns import basename


def _union(dfs: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name, rows`` for every table."""
    return _union([df.agg(F.count(F.lit(1)).alias("rows"))
                   .select(F.lit(name).alias("table_name"), "rows") for name, df in tables.items()])


def write_observed(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> dict[str, int]:
    """Writes ``df`` and returns, out of the same pass over it, its rows and each
    column's NULLs (``rows``, ``nulls_<column>``): no second scan to count."""
    seen = Observation(f"write_{uuid.uuid4().hex[:12]}")
    nulls = [F.count(F.when(F.col(f"`{c}`").isNull(), 1)).alias(f"nulls_{c}") for c in df.columns]
    w = df.observe(seen, F.count(F.lit(1)).alias("rows"), *nulls).write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
    return dict(seen.get)


def current_version_violations(dims: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Keys without exactly one current version (more than one, or none).
    Keys are reported as strings so integer and string keys can be unioned."""
    parts = []
    for name, (df, key) in dims.items():
        parts.append(df.groupBy(key)
                     .agg(F.count(F.when(F.col("is_current"), 1)).alias("current_versions"))
                     .filter(F.col("current_versions") != 1)
                     .select(F.lit(name).alias("dimension"), F.col(key).cast("string").alias("key_value"),
                             "current_versions"))
    return _union(parts)


def open_interval_violations(dims: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Current rows with an end date, and closed rows without one."""
    parts = []
    for name, (df, key) in dims.items():
        parts.append(df.filter(F.col("is_current") != F.col("valid_to").isNull())
                     .select(F.lit(name).alias("dimension"), F.col(key).cast("string").alias("key_value"),
                             "valid_from", "valid_to", "is_current"))
    return _union(parts)


def interval_violations(dims: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Versions of a key that run backwards or overlap the next version, or
    an open version followed by another one."""
    parts = []
    for name, (df, key) in dims.items():
        w = Window.partitionBy(key).orderBy("valid_from", F.col("valid_to").asc_nulls_last())
        nxt = F.lead("valid_from").over(w)
        v = df.select(key, "valid_from", "valid_to", nxt.alias("next_from"))
        issue = (F.when(F.col("valid_to") < F.col("valid_from"), F.lit("backwards"))
                 .when(F.col("next_from").isNotNull() & F.col("valid_to").isNull(), F.lit("open before next"))
                 .when(F.col("next_from") < F.col("valid_to"), F.lit("overlaps next")))
        parts.append(v.withColumn("issue", issue).filter(F.col("issue").isNotNull())
                     .select(F.lit(name).alias("dimension"), F.col(key).cast("string").alias("key_value"),
                             "valid_from", "valid_to", "issue"))
    return _union(parts)


def orphans(fact: DataFrame, fact_id: str, refs: Mapping[str, tuple[str, DataFrame, str]]) -> DataFrame:
    """Fact rows whose key has no row in the dimension (a NULL key is an
    orphan too). ``refs``: issue -> (fact key, dimension, dimension key)."""
    parts = []
    for issue, (fk, dim, dk) in refs.items():
        d = dim.select(F.col(dk).alias("_dk")).distinct()
        parts.append(fact.join(d, fact[fk] == d["_dk"], "left_anti")
                     .select(F.lit(issue).alias("issue"), F.col(fact_id),
                             F.col(fk).cast("string").alias("missing_key")))
    return _union(parts)


def lineage(bronze: DataFrame, file_col: str = "_source_file", by_basename: bool = True) -> DataFrame:
    """Rows ingested and first ingestion time per source file."""
    f = basename(file_col) if by_basename else F.col(file_col)
    return (bronze.groupBy(f.alias("source_file"))
            .agg(F.count(F.lit(1)).alias("rows_ingested"), F.min("_ingestion_ts").alias("ingested_at")))
