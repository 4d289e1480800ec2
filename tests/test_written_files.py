"""How many files a write leaves, and how often it evaluates its rows."""

from pathlib import Path

from pyspark.sql import functions as F

from strata.operators.publish import publish
from strata.sources.landing import land


def _files(path) -> dict[str, int]:
    found: dict[str, int] = {}
    for f in Path(path).rglob("*.parquet"):
        found[f.parent.name] = found.get(f.parent.name, 0) + 1
    return found


def test_publish_writes_a_small_partition_as_one_file(spark, tmp_path):
    rows = spark.range(0, 600, numPartitions=12).select("id", (F.col("id") % 5).alias("month"))
    back = publish(rows, str(tmp_path / "t"), ["month"])
    assert _files(tmp_path / "t") == {f"month={m}": 1 for m in range(5)}
    back = publish(back.filter("month < 2").withColumn("id", -F.col("id")).repartition(9), str(tmp_path / "t"), ["month"],
                   replace=[{"month": 0}, {"month": 1}])
    assert _files(tmp_path / "t") == {f"month={m}": 1 for m in range(5)}
    assert sorted(r["id"] for r in back.collect()) == sorted(-i if i % 5 < 2 else i for i in range(600))


def test_landing_by_batch_evaluates_its_rows_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for pdf in batches:
            seen.add(len(pdf))
            yield pdf

    rows = spark.range(0, 500, numPartitions=8).select("id", F.concat(F.lit("2024-0"), 1 + F.col("id") % 4).alias("batch_key"))
    land(rows.mapInPandas(counted, rows.schema), str(tmp_path / "z"), "parquet", by_batch=True)
    assert seen.value == 500
    assert _files(tmp_path / "z") == {f"batch_key=2024-0{m}": 1 for m in range(1, 5)}
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "z")).collect()) == list(range(500))
