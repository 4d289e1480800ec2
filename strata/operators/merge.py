"""Upsert without a table format.

``upsert`` is ``MERGE ... WHEN MATCHED UPDATE SET ... WHEN NOT MATCHED INSERT``
expressed as joins on the key; its result is a whole new snapshot, written to a
new location (or returned), and it never overwrites the table it reads.
``BucketedTable`` keeps a table in buckets by key and rewrites only the buckets
that a source touches.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.publish import Progress, publish, recover
from strata.session import path_exists


def _expr(v: str | Column) -> Column:
    return F.expr(v) if isinstance(v, str) else v


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           set_cols: Mapping[str, str | Column], insert_cols: Mapping[str, str | Column]) -> DataFrame:
    """Matched keys take ``set_cols``; source-only keys take ``insert_cols``;
    target-only keys are kept. Expressions refer to ``target.<c>`` and
    ``source.<c>``. The source must hold one row per key (dedup it first), as
    a merge would fail on several matching source rows.

    The target (a whole dimension) is the large side and the source (a batch)
    the small one: target LEFT JOIN source lets Spark broadcast the batch
    behind its size check, so the target is scanned, not shuffled; keys new
    to the target come from a key-only semi join and an anti join of two
    small sides."""
    t = target.alias("target")
    s = source.alias("source").withColumn("_in_s", F.lit(True))
    cond = [F.col(f"target.{k}") == F.col(f"source.{k}") for k in keys]
    j = t.join(s, cond, "left")
    matched = F.col("_in_s").isNotNull()
    updated = j.select(*[F.when(matched, _expr(set_cols[c])).otherwise(F.col(f"target.{c}")).alias(c)
                         if c in set_cols else F.col(f"target.{c}") for c in target.columns])
    found = target.select(*keys).join(source.select(*keys), list(keys), "left_semi")
    fresh = source.join(found, list(keys), "left_anti").alias("source")
    types = dict(target.dtypes)
    inserted = fresh.select(*[(_expr(insert_cols[c]) if c in insert_cols else F.lit(None)).cast(types[c]).alias(c)
                              for c in target.columns])
    return updated.unionByName(inserted)


def update_matched(target: DataFrame, source: DataFrame, keys: Sequence[str],
                   set_cols: Mapping[str, str | Column], target_filter: Column | None = None) -> DataFrame:
    """``MERGE ... WHEN MATCHED THEN UPDATE SET`` only: target rows whose key
    is in ``source`` (and that pass ``target_filter``) get ``set_cols``; all
    other target rows are returned unchanged. ``source`` holds one row per key."""
    t = target.alias("target")
    s = source.alias("source").withColumn("_in_s", F.lit(True))
    cond = [F.col(f"target.{k}") == F.col(f"source.{k}") for k in keys]
    if target_filter is not None:
        cond.append(target_filter)
    j = t.join(s, cond, "left")
    hit = F.col("_in_s").isNotNull()
    return j.select(*[F.when(hit, _expr(set_cols[c])).otherwise(F.col(f"target.{c}")).alias(c)
                      if c in set_cols else F.col(f"target.{c}") for c in target.columns])


BUCKET = "_bucket"


class BucketedTable:
    """A table of one row per key, in one directory per bucket of the key's hash.

    A merge finds the buckets that its source has keys of, reads those only,
    merges them and publishes them in place of the old ones; the files of all
    other buckets stay as they are. Work and writes so follow the source, not the
    table, once it has many more buckets than the source touches (choose
    ``buckets`` for buckets of some hundred MB). A merge given an ``epoch`` is
    recorded together with the data, so the same epoch again is a no-op, also
    after a stop at any point.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = 64):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), list(keys), buckets
        self.progress = Progress(spark, f"{self.path}_progress")

    def _bucketed(self, df: DataFrame) -> DataFrame:
        return df.withColumn(BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    def _state(self) -> dict:
        recover(self.spark, self.path)
        return self.progress.read()

    def _publish(self, df: DataFrame, touched: Sequence[int] | None, epoch: int | None, state: Mapping) -> None:
        value = {"schema": df.drop(BUCKET).schema.json(), "epoch": state.get("epoch") if epoch is None else epoch, "buckets": self.buckets}
        publish(df.hint("rebalance", BUCKET), self.path, [BUCKET], record=(self.progress, value),
                replace=None if touched is None else [{BUCKET: b} for b in touched])

    def create(self, df: DataFrame, epoch: int | None = None) -> None:
        """Writes the table anew from ``df``, one row per key."""
        self._publish(self._bucketed(df), None, epoch, self._state())

    def applied(self) -> int | None:
        """The last epoch merged."""
        return self._state().get("epoch")

    def read(self) -> DataFrame:
        state = self._state()
        if not state:
            raise ValueError(f"no table at {self.path}")
        schema = T.StructType.fromJson(json.loads(state["schema"]))
        whole = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])
        return self.spark.read.schema(whole).parquet(self.path).select(*[f"`{c}`" for c in schema.names], BUCKET)

    def rows(self) -> DataFrame:
        """The table's rows, without their bucket."""
        return self.read().drop(BUCKET)

    def _merge(self, source: DataFrame, epoch: int | None, merged) -> bool:
        state = self._state()
        if epoch is not None and state.get("epoch") is not None and epoch <= state["epoch"]:
            return False
        if state["buckets"] != self.buckets:
            raise ValueError(f"the table has {state['buckets']} buckets")
        source = self._bucketed(source)
        touched = sorted(r[0] for r in source.select(BUCKET).distinct().collect())  # at most the buckets there are
        if not touched:
            if epoch is not None:
                self.progress.write({**state, "epoch": epoch})
            return True
        target = self.read().filter(F.col(BUCKET).isin(touched))
        self._publish(merged(target, source), touched, epoch, state)
        return True

    def upsert(self, source: DataFrame, set_cols: Mapping[str, str | Column], insert_cols: Mapping[str, str | Column],
               epoch: int | None = None) -> bool:
        """``upsert`` into the touched buckets; False if the epoch was merged before."""
        return self._merge(source, epoch, lambda target, own: upsert(target, own, [BUCKET, *self.keys], set_cols,
                                                                     {BUCKET: f"source.{BUCKET}", **insert_cols}))

    def delete(self, keys: DataFrame, epoch: int | None = None) -> bool:
        """Removes the rows of ``keys``."""
        return self._merge(keys, epoch, lambda target, own: target.join(own.select(BUCKET, *self.keys), [BUCKET, *self.keys], "left_anti")
                           .select(*target.columns))

    def exists(self) -> bool:
        return bool(self._state()) and path_exists(self.spark, self.path)
