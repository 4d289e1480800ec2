"""Records kept whole as VARIANT: parsed once, keys and types as delivered.

A text column of JSON becomes one VARIANT column (``parsed``); typed columns are
taken from it by name (``fields``). Names are keys, not paths: dots, quotes and the
empty name mean themselves. A value that doesn't fit its type is NULL and named
in a list, so it can be rejected or looked at; nothing is lost, as the record stays.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parsed(text: str | Column) -> Column:
    """The JSON object in ``text`` as VARIANT; NULL for anything else (also for
    one with the same key twice)."""
    record = F.try_parse_json(F.col(text) if isinstance(text, str) else text)
    return F.when(F.startswith(F.schema_of_variant(record), F.lit("OBJECT<")), record)


def _keyed(record: Column) -> Column:
    return record.cast("map<string, variant>")


def _value(keys: Column, name: str, any_case: bool) -> Column:
    exact = keys[name]
    if not any_case:
        return exact
    # the exact spelling first, then the others in order of their keys
    alike = F.map_filter(keys, lambda k, v: F.lower(k) == name.lower())
    spelled = F.array_sort(F.map_keys(alike))
    return F.coalesce(exact, alike[F.element_at(spelled, F.when(F.size(spelled) > 0, 1))])


def fields(df: DataFrame, record: str, types: Mapping[str, str], any_case: bool = True, unfit: str | None = "_unfit") -> DataFrame:
    """``df`` with a column for each of ``types`` (key: SQL type) taken from the
    VARIANT column ``record``; ``any_case`` matches keys whatever their case.
    ``unfit`` lists the keys whose value is there but isn't of the type."""
    keys = _keyed(F.col(record))
    values = {name: _value(keys, name, any_case) for name in types}
    typed = {name: F.try_variant_get(v, "$", types[name]) for name, v in values.items()}
    out = df.select("*", *[c.alias(name) for name, c in typed.items()])
    if unfit is None:
        return out
    wrong = [F.when(v.isNotNull() & ~F.is_variant_null(v) & typed[name].isNull(), F.lit(name)) for name, v in values.items()]
    return df.select("*", *[c.alias(name) for name, c in typed.items()], F.array_compact(F.array(*wrong)).alias(unfit))


def schema_of(df: DataFrame, record: str) -> str:
    """The merged schema of all records, as DDL: which keys there are, in which types."""
    return df.agg(F.schema_of_variant_agg(F.col(record)).alias("s")).first()["s"]
