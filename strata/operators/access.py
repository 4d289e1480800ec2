"""Column masks and row filters by role, as DataFrame transforms.

These shape what a reader gets back; they are not an access boundary (that
needs a catalog). The role is passed in; the decision is a literal in the
plan, so Catalyst folds it away and the filter still reaches the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.columns import ENGINEERS, MASK_VALUE


def mask_pii(c: Column, role: str, allow: Sequence[str] = (ENGINEERS,)) -> Column:
    """The value for allowed roles, ``XXXX`` for everybody else."""
    return F.when(F.lit(role).isin(list(allow)), c).otherwise(F.lit(MASK_VALUE))


def current_only(is_current: Column, role: str, allow: Sequence[str] = (ENGINEERS,)) -> Column:
    """TRUE for allowed roles, else the row's ``is_current``."""
    return F.when(F.lit(role).isin(list(allow)), F.lit(True)).otherwise(is_current)


def mask_columns(df: DataFrame, cols: Sequence[str], role: str, allow: Sequence[str] = (ENGINEERS,)) -> DataFrame:
    return df.withColumns({c: mask_pii(F.col(c), role, allow) for c in cols})


def restrict_rows(df: DataFrame, role: str, predicate: Column | None = None,
                  allow: Sequence[str] = (ENGINEERS,)) -> DataFrame:
    pred = predicate if predicate is not None else F.col("is_current")
    return df.filter(F.when(F.lit(role).isin(list(allow)), F.lit(True)).otherwise(pred))


def register_sql_functions(spark: SparkSession) -> None:
    """The same two rules as SQL functions, for SQL users:
    ``mask_pii_name(name, role)`` and ``filter_current_only(is_current, role)``."""
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION mask_pii_name(name STRING, role STRING)
                  RETURNS STRING RETURN CASE WHEN role = '{ENGINEERS}' THEN name ELSE '{MASK_VALUE}' END""")
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION filter_current_only(is_current BOOLEAN, role STRING)
                  RETURNS BOOLEAN RETURN CASE WHEN role = '{ENGINEERS}' THEN true ELSE is_current END""")
