"""Column expressions shared by the operators.

All of these are built-in Spark expressions (JVM side, inside whole-stage
codegen); none of them is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for right results:
#   batch key inside a file name: four digits, dash, two digits ("2026-01")
#   masked value shown to readers outside the allowed roles: "XXXX"
#   role allowed to see names and closed versions: "data_engineers"
BATCH_KEY_PATTERN = r"(\d{4}-\d{2})"
MASK_VALUE = "XXXX"
ENGINEERS = "data_engineers"

# Money is stored as double (as in the reference) but summed exactly, with
# parts of a cent; sums are DECIMAL(38,6). Cleaning rejects amounts beyond
# MOST_MONEY and ones that aren't finite.
MONEY_SUM_TYPE = "decimal(28,6)"
MOST_MONEY = 1e15


def money(c: str | Column) -> Column:
    """A money column as an exact number; NULL if it isn't finite or doesn't fit."""
    return (F.col(c) if isinstance(c, str) else c).try_cast(MONEY_SUM_TYPE)



def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def basename(path: str | Column) -> Column:
    """Last segment of a file path (``a/b/c.json`` -> ``c.json``)."""
    return F.regexp_extract(col_of(path), r"([^/]*)$", 1)


def batch_key_of(path: str | Column, pattern: str = BATCH_KEY_PATTERN) -> Column:
    """Batch key of a file: a ``batch_key=<v>`` directory if the landing zone
    is partitioned that way, else the first match of ``pattern`` in the file's
    *basename* (never in the directories above it). NULL when neither exists."""
    p = col_of(path)
    from_dir = F.regexp_extract(p, r"/batch_key=([^/]+)/", 1)
    from_name = F.regexp_extract(basename(p), pattern, 1)
    return F.coalesce(F.nullif(from_dir, F.lit("")), F.nullif(from_name, F.lit("")))


def business_date(batch_key: str | Column) -> Column:
    """First day of the batch's month for ``yyyy-MM`` keys, the day itself for
    ``yyyy-MM-dd`` keys."""
    k = col_of(batch_key)
    return F.when(F.length(k) == 7, F.try_to_date(F.concat(k, F.lit("-01")), "yyyy-MM-dd")) \
        .otherwise(F.try_to_date(k, "yyyy-MM-dd"))


def tracked_struct(cols: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in cols])


def changed(new: Column, old: Column) -> Column:
    """Null-safe "is different": a change to or from NULL counts."""
    return ~new.eqNullSafe(old)


def valid_on(day: str | Column, valid_from: str = "valid_from", valid_to: str = "valid_to") -> Column:
    """Half-open validity: ``valid_from <= d < valid_to`` (open end = NULL)."""
    d = F.to_date(F.lit(day)) if isinstance(day, str) else day
    return (F.col(valid_from) <= d) & (F.col(valid_to).isNull() | (F.col(valid_to) > d))


def money_sum(c: str | Column) -> Column:
    """Exact sum of a money column, returned as double."""
    return F.sum(money(c)).cast("double")


