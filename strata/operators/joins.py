"""Joins of a dimension (one row per key) with a large fact, laid out so that
a hot key on the fact side can always be split.

AQE splits a skewed partition only on a side it may duplicate: either side of
an inner join, the preserved (left) side of a left outer / semi / anti join,
never a full outer join. So:

* existence tests (semi, anti) run against the fact's *distinct keys*, which
  are pre-aggregated map-side: a key holding a third of the facts becomes
  one row per map task before the shuffle;
* outer joins keep the fact on the left (splittable) and add the dimension
  rows without facts through an anti join on those distinct keys.

Each result has the same rows and columns as the plain ``df.join(...)`` of
the same type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fact_keys(fact: DataFrame, key: str) -> DataFrame:
    return fact.select(key).distinct()


def semi(dim: DataFrame, fact: DataFrame, key: str) -> DataFrame:
    return dim.join(fact_keys(fact, key), key, "left_semi")


def anti(dim: DataFrame, fact: DataFrame, key: str) -> DataFrame:
    return dim.join(fact_keys(fact, key), key, "left_anti")


def _dim_only(dim: DataFrame, fact: DataFrame, key: str) -> DataFrame:
    """Dimension rows without facts, with the fact columns as NULL."""
    missing = anti(dim, fact, key)
    types = dict(fact.dtypes)
    return missing.select(*dim.columns, *[F.lit(None).cast(types[c]).alias(c) for c in fact.columns if c != key])


def inner(dim: DataFrame, fact: DataFrame, key: str) -> DataFrame:
    j = fact.join(dim, key, "inner")
    return j.select(*dim.columns, *[c for c in fact.columns if c != key])


def left_outer(dim: DataFrame, fact: DataFrame, key: str) -> DataFrame:
    """Every dimension row, with its facts if any (``dim LEFT JOIN fact``)."""
    return inner(dim, fact, key).unionByName(_dim_only(dim, fact, key))


def right_outer(dim: DataFrame, fact: DataFrame, key: str) -> DataFrame:
    """Every fact row, with its dimension row if any (``dim RIGHT JOIN fact``)."""
    j = fact.join(dim, key, "left")
    return j.select(key, *[c for c in dim.columns if c != key], *[c for c in fact.columns if c != key])


def full_outer(dim: DataFrame, fact: DataFrame, key: str) -> DataFrame:
    """Both sides, NULL where there is no match (``dim FULL JOIN fact``)."""
    return right_outer(dim, fact, key).unionByName(_dim_only(dim, fact, key))
