"""
measurements") at $BENCH_SF_DIR on local[$BENCH_CPUS]. Prints one JSON line.
Each pair returns the same rows; best of $BENCH_REPEATS after a warm-up."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def timed(fn, repeats):
    fn()  # warm-up
    best = None
    for _ in range(repeats):
        t = time.time()
        fn()
        d = time.time() - t
        best = d if best is None else min(best, d)
    return round(best, 3)


def run(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    from strata.operators import gold
    from strata.plans import catalog as Q
    from strata.plans import feeds
    from strata.session import get_spark, scratch_dir
    spark = get_spark(f"local[{cpus}]", int(cpus))
    out = {}

    out["scd2_set_based"] = timed(lambda: run(Q.scd2_events_history(spark, sf)), repeats)
    out["scd2_per_batch_replay"] = timed(lambda: run(Q.scd2_events_replay(spark, sf)), 1)

    spend = lambda: gold.spend_per(feeds.fact_orders(spark, sf), Q._current_customers(spark, sf),
                                   "customer_id", ["name", "city"], "amount")
    out["ranking_filter_on_rank"] = timed(lambda: run(gold.rank_top(spend(), "total_amount", "customer_id", 100)),
                                          repeats)
    w = Window.orderBy(F.col("total_amount").desc(), F.col("customer_id"))
    out["ranking_sort_then_limit"] = timed(
        lambda: run(spend().withColumn("ranking", F.row_number().over(w)).orderBy("ranking").limit(100)), repeats)

    root = scratch_dir(spark, "bench-scan")
    staged = feeds.staged_users(spark, sf)
    staged.write.mode("overwrite").partitionBy("batch_key").parquet(f"{root}/by_batch")
    staged.write.mode("overwrite").parquet(f"{root}/flat")
    one = Q.CHANGE_BATCH
    out["one_batch_scan_partitioned"] = timed(
        lambda: run(spark.read.parquet(f"{root}/by_batch").filter(F.col("batch_key") == one)), repeats)
    out["one_batch_scan_unpartitioned"] = timed(
        lambda: run(spark.read.parquet(f"{root}/flat").filter(F.col("batch_key") == one)), repeats)

    out["pit_join_default"] = timed(lambda: run(Q.pit_revenue_by_type(spark, sf)), repeats)
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    out["pit_join_shuffled"] = timed(lambda: run(Q.pit_revenue_by_type(spark, sf)), repeats)
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)

    out["gold_pre_aggregate"] = timed(lambda: run(Q.sales_by_city(spark, sf)), repeats)

    def join_then_agg():
        f = feeds.fact_orders(spark, sf)
        d = Q._current_customers(spark, sf).select("customer_id", "city")
        return (f.join(d, "customer_id").groupBy("city")
                .agg(F.count("order_id").alias("total_orders"),
                     F.sum(F.col("amount").cast("decimal(18,2)")).cast("double").alias("total_amount")))
    out["gold_join_then_aggregate"] = timed(lambda: run(join_then_agg()), repeats)
    # Skew: one (key, day) group holds a third of the rows (events copied 20
    # times by a fixed rule; bench-only input). Dedup per (key, day) as a
    # window vs as the aggregation `dedup_latest` uses.
    from strata.operators.clean import dedup_latest
    ev = spark.read.parquet(f"{sf}/events.parquet")
    copies = ev.select("*", F.explode(F.sequence(F.lit(1), F.lit(20))).alias("copy"))
    hot = (F.col("event_id") + F.col("copy")) % 3 == 0
    skewed = copies.select(F.when(hot, F.lit(-1)).otherwise(F.col("user_id") * 100 + F.col("copy")).alias("user_id"),
                           (F.col("event_id") * 100 + F.col("copy")).alias("event_id"), "ts", "event_type",
                           F.when(hot, F.lit("2024-01-01")).otherwise(F.date_format("ts", "yyyy-MM-dd"))
                           .alias("batch_key"))
    wd = Window.partitionBy("user_id", "batch_key").orderBy(F.col("ts").desc(), F.col("event_id").desc())
    out["dedup_skewed_window"] = timed(
        lambda: run(skewed.withColumn("rn", F.row_number().over(wd)).filter("rn = 1").drop("rn")), repeats)
    out["dedup_skewed_aggregate"] = timed(
        lambda: run(dedup_latest(skewed, ["user_id", "batch_key"], ["ts", "event_id"])), repeats)
    print(json.dumps({"sf": os.path.basename(sf).replace("sf", ""), "cpus": int(cpus), "sec": out}))


if __name__ == "__main__":
    main()
