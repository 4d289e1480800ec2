"""Point-in-time reads of a type 2 dimension.

``pit_join`` joins each fact row to the dimension version valid on the fact's
date: key equality plus the half-open interval as a residual condition. Spark
plans it as an equi-join on the key (broadcast-hash when AQE measures the
dimension below its broadcast limit at run time, otherwise sort-merge with
skew splitting), never as a range or nested-loop join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import valid_on


def state_on(dim: DataFrame, day: str | Column) -> DataFrame:
    """Versions valid on ``day``: ``valid_from <= day < valid_to``."""
    return dim.filter(valid_on(day))


def _bucket(d: Column, unit: str) -> Column:
    if unit == "month":
        return F.year(d) * 12 + F.month(d) - 1
    if unit == "year":
        return F.year(d)
    raise ValueError(f"bucket must be 'month' or 'year', not {unit!r}")


def pit_join(fact: DataFrame, dim: DataFrame, keys: Sequence[str] | Mapping, date_col: str,
             how: str = "inner", dim_cols: Sequence[str] | None = None, bucket: str | None = None) -> DataFrame:
    """Fact rows joined to the dimension version valid on ``fact[date_col]``.

    ``keys`` is a list of shared key names or a ``{fact_col: dim_col}`` map.
    Returns the fact columns plus ``dim_cols`` (default: the dimension's
    non-key, non-interval columns).

    Each fact row is checked against the versions of its key, so the cost is
    fact rows × versions per key (at most one version per batch). For
    dimensions with long histories per key, ``bucket="month"`` / ``"year"``
    replicates each version into the periods it covers and adds the period
    to the join key: a fact row then meets only the versions overlapping its
    period. Open versions run to the last fact date (one aggregated value).
    """
    if bucket and how not in ("inner", "left", "left_outer", "leftouter"):
        raise ValueError("bucket replicates versions, so a join that keeps unmatched ones would repeat them")
    pairs = dict(keys) if isinstance(keys, Mapping) else {k: k for k in keys}
    drop = set(pairs.values()) | {"valid_from", "valid_to", "is_current"}
    dim_cols = list(dim_cols) if dim_cols is not None else [c for c in dim.columns if c not in drop]
    d = dim.select(*[F.col(v).alias(f"_d_{v}") for v in pairs.values()],
                   F.col("valid_from").alias("_d_from"), F.col("valid_to").alias("_d_to"), *dim_cols)
    f = fact
    day = f[date_col].cast("date")
    if bucket:
        last = fact.agg(F.max(F.col(date_col).cast("date"))).first()[0]
        if last is None:  # no facts: nothing can match
            last = "1970-01-01"
        hi = F.coalesce(F.date_sub(F.col("_d_to"), 1), F.to_date(F.lit(str(last))))
        d = (d.filter(F.col("_d_to").isNull() | (F.col("_d_to") > F.col("_d_from")))
             .filter(hi >= F.col("_d_from"))
             .withColumn("_d_b", F.explode(F.sequence(_bucket(F.col("_d_from"), bucket), _bucket(hi, bucket)))))
        f = fact.withColumn("_f_b", _bucket(F.col(date_col).cast("date"), bucket))
        day = f[date_col].cast("date")
    on = [f[fk] == d[f"_d_{dk}"] for fk, dk in pairs.items()]
    if bucket:
        on.append(f["_f_b"] == d["_d_b"])
    on.append(d["_d_from"] <= day)
    on.append(d["_d_to"].isNull() | (d["_d_to"] > day))
    joined = f.join(d, on, how)
    return joined.select(*[f[c] for c in fact.columns], *[d[c] for c in dim_cols])
