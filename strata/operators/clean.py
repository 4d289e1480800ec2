"""Cleaning: typed projection, declarative quality rules, rejects, dedup.

``clean`` never raises on dirty input: every cast is a ``try_*`` cast (ANSI
mode makes plain casts throw), and every failed rule becomes a *reason* on a
rejected row instead of a silent drop.

Dedup is an aggregation, not a window: ``max(struct(order..., payload...))``
per key. It is partially aggregated map-side, so a key that holds a third of
all rows collapses to one row per map task before the shuffle instead of
landing whole in one sort task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import MOST_MONEY

REASON = "_reject_reason"


@dataclass(frozen=True)
class Rule:
    """A row passes when ``check`` (a Column or a SQL predicate) is TRUE;
    FALSE or NULL rejects it with ``reason``. Rules are evaluated in order;
    the first failure is reported."""

    reason: str
    check: Column | str

    def column(self) -> Column:
        return F.expr(self.check) if isinstance(self.check, str) else self.check


def not_null(c: str) -> Rule:
    return Rule(f"{c} is null or not parseable", f"`{c}` IS NOT NULL")


def positive(c: str) -> Rule:
    return Rule(f"{c} not > 0", f"`{c}` > 0")


def amount_in_range(c: str, most: float = MOST_MONEY) -> Rule:
    """Finite and at most ``most`` either way (NaN compares above every number)."""
    return Rule(f"{c} not finite or beyond {most:g}", f"`{c}` BETWEEN -{most!r}D AND {most!r}D")


def typed(df: DataFrame, exprs: Mapping[str, Column | str] | Sequence[str],
          keep_raw: Sequence[str] = ()) -> DataFrame:
    """Project raw (string) columns to typed ones. In a mapping, a string
    value is a target type, applied with ``try_cast``; ``"date"`` /
    ``"date:<pattern>"`` parse with ``try_to_date``; a Column is used as is.
    A plain list holds SQL select expressions (``"TRY_CAST(x AS INT) AS x"``)."""
    cols = [F.col(c).alias(f"_raw_{c}") for c in keep_raw]
    if not isinstance(exprs, Mapping):  # SQL select expressions, selectExpr style
        return df.select(*cols, *[F.expr(e) for e in exprs])
    for name, e in exprs.items():
        if isinstance(e, str) and e.startswith("date"):
            fmt = e.partition(":")[2]
            e = F.try_to_date(F.col(name), fmt) if fmt else F.try_to_date(F.col(name))
        elif isinstance(e, str):
            e = F.col(name).try_cast(e)
        cols.append(e.alias(name))
    return df.select(*cols)


def tag_rejects(df: DataFrame, rules: Sequence[Rule], fill: Mapping[str, object] | None = None) -> DataFrame:
    """Add ``_reject_reason`` (NULL = good row). ``fill`` defaults NULLs first,
    exactly like ``fillna`` before the filters in a cleaning chain."""
    if fill:
        df = df.na.fill(dict(fill))
    reason = F.coalesce(*[F.when(F.coalesce(r.column(), F.lit(False)), F.lit(None)).otherwise(F.lit(r.reason))
                          for r in rules]) if rules else F.lit(None).cast("string")
    return df.withColumn(REASON, reason)


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Keep one row per key: the greatest by ``order``; remaining ties are
    broken by the other columns, so the result is deterministic."""
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    payload = [c for c in df.columns if c not in keys]
    ordering = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order_cols)],
                        *[F.col(c) for c in payload])
    best = df.groupBy(*keys).agg(F.max(ordering).alias("_best"))
    return best.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in payload])


def clean(df: DataFrame, exprs: Mapping[str, Column | str] | Sequence[str], rules: Sequence[Rule],
          key: Sequence[str] | None = None, order: Sequence[str | Column] = (),
          fill: Mapping[str, object] | None = None, raw_cols: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Typed, rule-checked, deduplicated rows and the rejected rows.

    Returns ``(good, rejected)``. ``rejected`` carries the raw input columns
    named in ``raw_cols`` (as delivered) and ``reject_reason``.
    """
    t = tag_rejects(typed(df, exprs, keep_raw=raw_cols), rules, fill)
    good = t.filter(F.col(REASON).isNull()).drop(REASON, *[f"_raw_{c}" for c in raw_cols])
    if key:
        good = dedup_latest(good, key, order or key)
    rejected = t.filter(F.col(REASON).isNotNull()).select(
        *[F.col(f"_raw_{c}").alias(c) for c in raw_cols], F.col(REASON).alias("reject_reason"))
    return good, rejected
