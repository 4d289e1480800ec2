"""Plan properties that the scale design depends on (checked on the
physical plan text, as `explain()` prints it)."""

import contextlib
import io

from pyspark.sql import functions as F

from strata.operators import joins, scd
from strata.operators.gold import rank_top
from strata.plans import catalog as Q

SF = "/root/testdata/sf0.01"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_top_k_is_limited_before_the_global_window(spark):
    df = spark.range(0, 1000).select(F.col("id").alias("k"), (F.col("id") % 7).cast("double").alias("v"))
    p = plan(rank_top(df, "v", "k", 10))
    assert "TakeOrderedAndProject(limit=10" in p


def test_skew_safe_full_outer_has_no_full_outer_join(spark):
    dim = spark.range(0, 100).select(F.col("id").alias("k"), F.lit("x").alias("name"))
    fact = spark.range(0, 1000).select((F.col("id") % 150).alias("k"), F.col("id").alias("order_id"))
    p = plan(joins.full_outer(dim, fact, "k"))
    assert "FullOuter" not in p and "LeftOuter" in p and "LeftAnti" in p


def test_per_batch_step_does_not_shuffle_current_rows(spark, workdir):
    cur = spark.range(0, 5000).select(F.col("id").alias("k"), F.lit("a").alias("v"),
                                      F.to_date(F.lit("2026-01-01")).alias("valid_from"),
                                      F.lit(None).cast("date").alias("valid_to"), F.lit(True).alias("is_current"))
    cur.write.parquet(f"{workdir}/cur")
    batch = spark.range(0, 50).select((F.col("id") * 200).alias("k"), F.lit("b").alias("v"),
                                      F.to_date(F.lit("2026-02-01")).alias("eff"))
    batch.write.parquet(f"{workdir}/batch")
    p = plan(scd.scd2_apply(spark.read.parquet(f"{workdir}/cur"), spark.read.parquet(f"{workdir}/batch"),
                            ["k"], ["v"], "eff"))
    assert "Exchange hashpartitioning" not in p
    assert p.count("BroadcastExchange") >= 2


def test_flagship_scans_only_needed_columns(spark):
    p = plan(Q.pit_revenue_by_type(spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in p
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in p


def test_one_batch_read_prunes_partitions(spark, workdir):
    from strata.sources.landing import land
    from strata.streaming.bronze import SourceSpec, ingest, read_bronze
    df = spark.range(0, 300).select(F.col("id").cast("string").alias("id"),
                                    F.concat(F.lit("2026-0"), (F.col("id") % 3 + 1).cast("string"),
                                             F.lit("-15")).alias("batch_key"))
    land(df, f"{workdir}/land", "json")
    ingest(spark, SourceSpec("x", "json", f"{workdir}/land"), f"{workdir}/b", f"{workdir}/c", f"{workdir}/s")
    one = read_bronze(spark, f"{workdir}/b", f"{workdir}/s").filter(F.col("batch_key") == "2026-02-15")
    p = plan(one)
    assert "PartitionFilters: [" in p and "2026-02-15" in p.split("PartitionFilters: [")[1].split("]")[0]
    assert one.count() == 100


def test_shared_root_without_checkpoint_setting(tmp_path):
    """A session with no spark.checkpoint.dir gets one through the context
    (a core setting cannot be changed on a running session)."""
    import os
    import subprocess
    import sys
    conf = tmp_path / "conf"
    conf.mkdir()
    code = ("import sys; sys.path.insert(0, %r)\n"
            "from pyspark.sql import SparkSession\n"
            "s = SparkSession.builder.master('local[1]').getOrCreate()\n"
            "from strata.session import shared_root\n"
            "a = shared_root(s); b = shared_root(s)\n"
            "print('ROOT', a == b and bool(a))\n") % str(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    out = subprocess.run([sys.executable, "-c", code], env={**os.environ, "SPARK_CONF_DIR": str(conf)},
                         capture_output=True, text=True, timeout=300)
    assert "ROOT True" in out.stdout, out.stderr[-1500:]
