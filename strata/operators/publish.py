"""Replacing a table, or some of its partitions, so that a stop loses nothing.

``publish`` writes the new rows apart (``<path>.ready/data``), then a plan
(``<path>.ready/plan.json``), then moves the data into place. The plan is the
commit: before it exists the table is untouched and what was written is thrown
away; once it exists, ``recover`` (which every publish runs first) completes the
move however far it came. As the rows are written apart, they may be computed
from the table that they replace.

A reader that lists the table in the middle of a move can miss partitions that
are being replaced; run readers after the publish, as the layered flow does.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import delete_path, move_path, names_below, path_exists, read_text, write_text

READY = ".ready"


class Progress:
    """What one consumer has applied: a small JSON value, replaced as a whole.

    Every write is a new file, moved into place under the next number; the
    highest number counts, so a stop leaves the old value or the new one.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _numbers(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in names_below(self.spark, self.path) if n.endswith(".json"))

    def read(self) -> dict:
        found = self._numbers()
        return json.loads(read_text(self.spark, f"{self.path}/{found[-1]:08d}.json")) if found else {}

    def write(self, value: Mapping) -> None:
        found = self._numbers()
        number = found[-1] + 1 if found else 1
        write_text(self.spark, f"{self.path}/{number:08d}.tmp", json.dumps(value))
        move_path(self.spark, f"{self.path}/{number:08d}.tmp", f"{self.path}/{number:08d}.json")
        for old in found:
            delete_path(self.spark, f"{self.path}/{old:08d}.json")


def _partitions(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Relative directories of the partitions below ``path``."""
    found = [""]
    for _ in range(depth):
        found = [f"{p}{n}/" for p in found for n in names_below(spark, f"{path}/{p}") if "=" in n]
    return [p.rstrip("/") for p in found if p]


def partition_dir(spark: SparkSession, values: Mapping[str, object]) -> str:
    """The directory of a partition, as Spark names it."""
    name = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    return "/".join(name(c, None if v is None else str(v)) for c, v in values.items())


def _move(spark: SparkSession, path: str) -> None:
    ready = f"{path}{READY}"
    plan = json.loads(read_text(spark, f"{ready}/plan.json"))
    if plan["partitions"] is None:
        if path_exists(spark, f"{ready}/data"):
            delete_path(spark, path)
            move_path(spark, f"{ready}/data", path)
    else:
        for part in plan["partitions"]:
            if path_exists(spark, f"{ready}/data/{part}"):  # else it has been moved
                delete_path(spark, f"{path}/{part}")
                move_path(spark, f"{ready}/data/{part}", f"{path}/{part}")
        for part in plan["emptied"]:
            delete_path(spark, f"{path}/{part}")
    if plan["record"]:
        Progress(spark, plan["record"]["path"]).write(plan["record"]["value"])
    delete_path(spark, f"{ready}/data")
    delete_path(spark, ready)


def recover(spark: SparkSession, path: str) -> bool:
    """Completes or discards what a stopped publish left; whether it completed one."""
    if not path_exists(spark, f"{path}{READY}"):
        return False
    done = path_exists(spark, f"{path}{READY}/plan.json")
    if done:
        _move(spark, path)
    else:
        delete_path(spark, f"{path}{READY}")
    return done


def read_table(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The table with the columns of ``like`` (which an empty one couldn't tell)."""
    return spark.read.schema(like.schema).parquet(path).select(*like.columns)


def publish(df: DataFrame, path: str, partition_by: Sequence[str] = (),
            replace: Sequence[Mapping[str, object]] | None = None, record: tuple[Progress, Mapping] | None = None) -> DataFrame:
    """Replaces the table at ``path`` by ``df``, or only the partitions named in
    ``replace`` (values by partition column): those which ``df`` has no rows
    for are removed, and ``df`` must have none of others. Returns the table.

    A table that doesn't exist yet is written whole. ``record`` is a value that a
    ``Progress`` gets with the table: after a stop both are new or both are old.
    """
    spark = df.sparkSession
    recover(spark, path)
    data = f"{path}{READY}/data"
    # one task a partition, more where it is large: not a file for each task and partition
    dealt = df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df
    w = dealt.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(data)
    plan: dict = {"partitions": None, "emptied": [], "record": None}
    if record is not None:
        plan["record"] = {"path": record[0].path, "value": dict(record[1])}
    if replace is not None and path_exists(spark, path):
        there = _partitions(spark, data, len(partition_by))
        wanted = [partition_dir(spark, {c: v[c] for c in partition_by}) for v in replace]
        if not set(there) <= set(wanted):
            raise ValueError(f"rows outside of the partitions to replace: {sorted(set(there) - set(wanted))[:5]}")
        plan |= {"partitions": there, "emptied": sorted(set(wanted) - set(there))}
    write_text(spark, f"{path}{READY}/plan.json", json.dumps(plan))
    _move(spark, path)
    return read_table(spark, path, df)
