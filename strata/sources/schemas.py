"""Declared schemas of the layered tables and ``ensure_table``.

Keys are BIGINT (the reference declares INT, which overflows at scale) and
money is DOUBLE (summed through DECIMAL). ``ensure_table`` only creates: an
existing table is never replaced by an empty one (the reference's table
creation overwrites data when rerun).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import path_exists

S, L, I, D, B, DT, TS = (T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType(),
                         T.DateType(), T.TimestampType())


def _schema(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


ENVELOPE = [("_ingestion_ts", TS), ("_ingestion_date", DT), ("_source_file", S), ("batch_key", S)]

# name -> (schema, partition columns)
SCHEMAS: dict[str, tuple[T.StructType, tuple[str, ...]]] = {
    "bronze_customers": (_schema(("customer_id", S), ("name", S), ("city", S), ("event_date", S), *ENVELOPE),
                         ("batch_key",)),
    "bronze_orders": (_schema(("order_id", S), ("customer_id", S), ("product_id", S), ("amount", S),
                              ("order_date", S), *ENVELOPE), ("batch_key",)),
    "bronze_products": (_schema(("product_id", S), ("product_name", S), ("category", S), ("price", S),
                                ("launch_date", S), *ENVELOPE), ("batch_key",)),
    "stg_customers": (_schema(("customer_id", L), ("name", S), ("city", S), ("event_date", DT), ("batch_key", S)),
                      ("batch_key",)),
    "stg_products": (_schema(("product_id", S), ("product_name", S), ("category", S), ("price", D),
                             ("launch_date", DT), ("batch_key", S), ("business_date", DT)), ("batch_key",)),
    "dim_customers_type1": (_schema(("customer_id", L), ("name", S), ("city", S), ("update_date", DT)), ()),
    "dim_customers_type2": (_schema(("customer_id", L), ("name", S), ("city", S), ("valid_from", DT),
                                    ("valid_to", DT), ("is_current", B)), ()),
    "dim_products_type2": (_schema(("product_id", S), ("product_name", S), ("category", S), ("price", D),
                                   ("valid_from", DT), ("valid_to", DT), ("is_current", B)), ()),
    "fact_orders": (_schema(("order_id", L), ("customer_id", L), ("product_id", S), ("amount", D),
                            ("order_date", DT), ("batch_key", S), ("year", I), ("month", I)), ("year", "month")),
    "sales_by_city": (_schema(("city", S), ("total_orders", L), ("total_amount", D), ("update_date", DT)), ()),
    "sales_by_category": (_schema(("category", S), ("total_orders", L), ("total_amount", D),
                                  ("unique_products", L), ("update_date", DT)), ()),
    "ranking_customers": (_schema(("customer_id", L), ("name", S), ("city", S), ("total_amount", D),
                                  ("ranking", I)), ()),
}


def ensure_table(spark: SparkSession, path: str, schema: T.StructType,
                 partition_by: Sequence[str] = ()) -> bool:
    """Create an empty typed table at ``path`` unless one exists there. Returns
    whether it was created. Read it with ``read_table``: an empty partitioned
    table has no file to take its schema from."""
    if path_exists(spark, path):
        return False
    w = spark.createDataFrame([], schema).write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return True


# Types that an existing table's column can be read as without losing anything.
_WIDENS = {("int", "bigint"), ("smallint", "int"), ("smallint", "bigint"), ("tinyint", "smallint"), ("tinyint", "int"),
           ("tinyint", "bigint"), ("float", "double"), ("int", "double"), ("smallint", "double")}


def compare_schema(existing: T.StructType, declared: T.StructType) -> list[tuple[str, str, str | None, str | None]]:
    """(column, status, existing type, declared type) in the declared order, then
    the table's own: ``same``, ``widened`` (can be read as declared), ``conflict``
    (cannot), ``added`` (declared only: NULL when read), ``extra`` (the table's only).
    Names are compared without case, as Spark does."""
    old = {f.name.lower(): f for f in existing}
    out = []
    for f in declared:
        there = old.pop(f.name.lower(), None)
        new = f.dataType.simpleString()
        if there is None:
            out.append((f.name, "added", None, new))
        else:
            was = there.dataType.simpleString()
            out.append((f.name, "same" if was == new else "widened" if (was, new) in _WIDENS else "conflict", was, new))
    return out + [(f.name, "extra", f.dataType.simpleString(), None) for f in old.values()]


def as_declared(df: DataFrame, declared: T.StructType) -> DataFrame:
    """A table's rows under the declared schema: missing columns are NULL, wider
    types are cast, conflicting values are ``try_cast`` (NULL where they don't fit),
    further columns are left out."""
    there = {c.lower(): c for c in df.columns}
    return df.select(*[(F.col(f"`{there[f.name.lower()]}`").try_cast(f.dataType) if f.name.lower() in there
                        else F.lit(None).cast(f.dataType)).alias(f.name) for f in declared])


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table with its declared schema, empty or not."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def ensure_all(spark: SparkSession, root: str) -> dict[str, str]:
    """All layered tables under ``root``; existing ones are left alone."""
    paths = {}
    for name, (schema, parts) in SCHEMAS.items():
        paths[name] = f"{root}/{name}"
        ensure_table(spark, paths[name], schema, parts)
    return paths
