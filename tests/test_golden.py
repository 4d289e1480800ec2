"""The reference's sample batches through ingest -> SCD -> as-of (FIXTURES.md)."""

import datetime as dt

from pyspark.sql import functions as F

from sample import write_customers, write_products
from strata.operators.asof import state_on
from strata.operators.scd import batch_change_log
from strata.plans.flow import Landing, run_layers
from strata.streaming.bronze import SourceSpec

D = dt.date


# Orders of our own (the reference ships none): 4 in January, 3 in June, plus
# dirty rows that cleaning must reject and one order re-sent in June.
ORDERS = [
    ("1", "101", "P001", "999.0", "2026-01-10", "2026-01"), ("2", "102", "P003", "29.9", "2026-01-11", "2026-01"),
    ("3", "103", "P002", "2499.0", "2026-01-12", "2026-01"), ("4", "101", "P004", "15.9", "2026-01-13", "2026-01"),
    ("5", "104", "P005", "199.0", "2026-06-02", "2026-06"), ("6", "101", "P001", "899.0", "2026-06-03", "2026-06"),
    ("7", "102", "P003", "34.9", "2026-06-04", "2026-06"),
    ("x8", "101", "P001", "10.0", "2026-06-05", "2026-06"),      # bad id
    ("9", "101", None, "10.0", "2026-06-05", "2026-06"),         # no product
    ("10", "101", "P001", None, "2026-06-05", "2026-06"),        # no amount -> 0 -> rejected
    ("4", "101", "P004", "15.9", "2026-01-13", "2026-06"),       # re-sent
]


def _run(spark, workdir, counts=None):
    from strata.sources.landing import land
    write_customers(f"{workdir}/land/customers")
    write_products(f"{workdir}/land/products")
    orders = spark.createDataFrame(ORDERS, "order_id string, customer_id string, product_id string, "
                                           "amount string, order_date string, batch_key string")
    import os
    if not os.path.exists(f"{workdir}/land/orders"):
        land(orders, f"{workdir}/land/orders", "parquet", files_per_batch=1)
    landing = Landing(SourceSpec("customers", "json", f"{workdir}/land/customers"),
                      SourceSpec("products", "csv", f"{workdir}/land/products"),
                      SourceSpec("orders", "parquet", f"{workdir}/land/orders"))
    return run_layers(spark, landing, f"{workdir}/lake", as_of="2026-07-01", counts=counts)


def test_sample_batches(spark, workdir):
    counts = {}
    paths = _run(spark, workdir, counts)
    read = lambda k: spark.read.parquet(paths[k])
    assert read("bronze_customers").count() == 7
    assert read("bronze_products").count() == 9

    t1 = {r.customer_id: (r.name, r.city, r.update_date) for r in read("silver/dim_customers_type1").collect()}
    assert t1 == {101: ("John", "Mountain View", D(2026, 6, 1)), 102: ("Mary", "Cupertino", D(2026, 6, 1)),
                  103: ("Charles", "Palo Alto", D(2026, 6, 1)), 104: ("Anna", "Sunnyvale", D(2026, 6, 1))}

    t2 = sorted((r.customer_id, r.city, r.valid_from, r.valid_to, r.is_current)
                for r in read("silver/dim_customers_type2").collect())
    assert t2 == sorted([
        (101, "San Francisco", D(2026, 1, 1), D(2026, 6, 1), False),
        (101, "Mountain View", D(2026, 6, 1), None, True),
        (102, "San Jose", D(2026, 1, 1), D(2026, 6, 1), False),
        (102, "Cupertino", D(2026, 6, 1), None, True),
        (103, "Palo Alto", D(2026, 1, 1), None, True),
        (104, "Sunnyvale", D(2026, 6, 1), None, True),
    ])
    p2 = sorted((r.product_id, r.price, r.valid_from, r.valid_to, r.is_current)
                for r in read("silver/dim_products_type2").collect())
    assert p2 == sorted([
        ("P001", 999.0, D(2026, 1, 1), D(2026, 6, 1), False),
        ("P001", 899.0, D(2026, 6, 1), None, True),
        ("P002", 2499.0, D(2026, 1, 1), None, True),
        ("P003", 29.9, D(2026, 1, 1), D(2026, 6, 1), False),
        ("P003", 34.9, D(2026, 6, 1), None, True),
        ("P004", 15.9, D(2026, 1, 1), None, True),
        ("P005", 199.0, D(2026, 6, 1), None, True),
    ])
    dim = read("silver/dim_customers_type2")
    on_0315 = {r.customer_id: r.city for r in state_on(dim, "2026-03-15").collect()}
    assert on_0315 == {101: "San Francisco", 102: "San Jose", 103: "Palo Alto"}
    on_0601 = {r.customer_id: r.city for r in state_on(dim, "2026-06-01").collect()}
    assert on_0601 == {101: "Mountain View", 102: "Cupertino", 103: "Palo Alto", 104: "Sunnyvale"}

    log = {r.batch_key: (r.inserted, r.updated, r.unchanged) for r in batch_change_log(
        read("silver/stg_customers"), ["customer_id"], ["name", "city"], "event_date").collect()}
    assert log == {"2026-01": (3, 0, 0), "2026-06": (1, 2, 1)}

    assert counts["silver/dim_customers_type1"] == 4 and counts["silver/dim_customers_type2"] == 6
    assert counts["silver/dim_products_type2"] == 7 and counts["silver/fact_orders"] == 7
    fact = read("silver/fact_orders")
    assert sorted(r.order_id for r in fact.collect()) == [1, 2, 3, 4, 5, 6, 7]
    assert {r.reject_reason for r in read("silver/rejects_orders").collect()} == {
        "order_id is null or not parseable", "product_id is null or not parseable", "amount not > 0"}
    city = {r.city: (r.total_orders, r.total_amount) for r in read("gold/sales_by_city").collect()}
    assert city == {"Mountain View": (3, 1913.9), "Cupertino": (2, 64.8), "Palo Alto": (1, 2499.0),
                    "Sunnyvale": (1, 199.0)}
    cat = {r.category: (r.total_orders, r.unique_products) for r in read("gold/sales_by_category").collect()}
    assert cat == {"Electronics": (4, 3), "Clothing": (2, 1), "Groceries": (1, 1)}
    top = [(r.ranking, r.customer_id) for r in read("gold/ranking_customers").orderBy("ranking").collect()]
    assert top == [(1, 103), (2, 101), (3, 104), (4, 102)]


def test_rerun_is_idempotent(spark, workdir):
    first = _run(spark, workdir)
    snap = spark.read.parquet(first["silver/dim_customers_type2"]).collect()
    again = _run(spark, workdir)  # same landing files, same checkpoints
    assert spark.read.parquet(again["bronze_customers"]).count() == 7
    assert spark.read.parquet(again["silver/fact_orders"]).count() == 7
    assert sorted(spark.read.parquet(again["silver/dim_customers_type2"]).collect()) == sorted(snap)


def test_csv_reordered_header_and_new_json_column(spark, workdir):
    write_products(f"{workdir}/land/products", header=("price", "product_id", "product_name",
                                                        "category", "launch_date"))
    write_customers(f"{workdir}/land/customers", extra={"customers_2026-06.json": {"tier": "gold"}})
    from strata.streaming.bronze import ingest, read_bronze
    ingest(spark, SourceSpec("products", "csv", f"{workdir}/land/products"),
           f"{workdir}/b/p", f"{workdir}/c/p", f"{workdir}/s/p")
    prices = {r.product_id: r.price for r in read_bronze(spark, f"{workdir}/b/p", f"{workdir}/s/p").collect()}
    assert prices["P001"] in ("999.00", "899.00") and prices["P005"] == "199.00"
    ingest(spark, SourceSpec("customers", "json", f"{workdir}/land/customers"),
           f"{workdir}/b/c", f"{workdir}/c/c", f"{workdir}/s/c")
    b = read_bronze(spark, f"{workdir}/b/c", f"{workdir}/s/c")
    tiers = {(r.batch_key, r.tier) for r in b.select("batch_key", "tier").collect()}
    assert tiers == {("2026-01", None), ("2026-06", "gold")}
    # draining again adds nothing
    ingest(spark, SourceSpec("customers", "json", f"{workdir}/land/customers"),
           f"{workdir}/b/c", f"{workdir}/c/c", f"{workdir}/s/c")
    assert read_bronze(spark, f"{workdir}/b/c", f"{workdir}/s/c").count() == 7
    from strata.streaming.bronze import new_files
    spec = SourceSpec("customers", "json", f"{workdir}/land/customers")
    assert new_files(spark, spec, f"{workdir}/b/c") == []  # schema inference skips ingested files
    assert b.filter(F.col("_source_file").endswith("customers_2026-06.json")).count() == 4


def test_optimize_keeps_rows(spark, workdir):
    from strata.plans.flow import optimize_layers
    paths = _run(spark, workdir)
    new = optimize_layers(spark, paths, "v2", files=2)
    for name in ("silver/fact_orders", "silver/dim_customers_type2", "bronze_customers"):
        a = spark.read.parquet(paths[name])
        b = spark.read.parquet(new[name]).select(*a.columns)
        assert new[name].endswith("@v2")
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_views_and_bound_parameters(spark, workdir):
    from strata.plans.flow import register_views
    paths = _run(spark, workdir)
    views = register_views(spark, paths)
    assert "silver_dim_customers_type2" in views
    rows = spark.sql("""
        SELECT customer_id, city FROM silver_dim_customers_type2
        WHERE valid_from <= :d AND (valid_to > :d OR valid_to IS NULL)
        ORDER BY customer_id""", args={"d": dt.date(2026, 3, 15)}).collect()
    assert [(r.customer_id, r.city) for r in rows] == [(101, "San Francisco"), (102, "San Jose"), (103, "Palo Alto")]
    counts = {r.table_name: r.rows for r in spark.sql("""
        SELECT 'dim_customers_type1' AS table_name, COUNT(*) AS rows FROM silver_dim_customers_type1
        UNION ALL SELECT 'dim_customers_type2', COUNT(*) FROM silver_dim_customers_type2
        UNION ALL SELECT 'dim_products_type2', COUNT(*) FROM silver_dim_products_type2
        UNION ALL SELECT 'fact_orders', COUNT(*) FROM silver_fact_orders""").collect()}
    assert counts == {"dim_customers_type1": 4, "dim_customers_type2": 6, "dim_products_type2": 7, "fact_orders": 7}


def test_incremental_runs_equal_rebuild(spark, workdir):
    """Batch 2026-01, then 2026-06, then a late 2026-03 batch: after each run
    the dimensions equal a set-based rebuild over what has landed."""
    import json
    import os

    from strata.operators import scd
    from strata.plans.flow import run_incremental, stage_customers, stage_products
    from strata.streaming.bronze import read_bronze
    from sample import CUSTOMERS, PRODUCTS
    land_c, land_p = f"{workdir}/land/customers", f"{workdir}/land/products"
    landing = Landing(SourceSpec("customers", "json", land_c), SourceSpec("products", "csv", land_p))
    lake = f"{workdir}/lake"

    def check():
        out = run_incremental(spark, landing, lake, as_of="2026-07-01")
        cust, _ = stage_customers(read_bronze(spark, f"{lake}/bronze/customers", f"{lake}/_schemas/customers"))
        prod, _ = stage_products(read_bronze(spark, f"{lake}/bronze/products", f"{lake}/_schemas/products"))
        want = {
            "dim_customers_type2": scd.scd2(cust, ["customer_id"], ["name", "city"], "event_date"),
            "dim_products_type2": scd.scd2(prod, ["product_id"], ["product_name", "category", "price"],
                                           "business_date"),
            "dim_customers_type1": scd.scd1(cust, ["customer_id"], ["name", "city"], "event_date"),
        }
        for name, df in want.items():
            got = out[name].select(*df.columns)
            assert got.exceptAll(df).count() == 0 and df.exceptAll(got).count() == 0, name
        return out

    write_customers(land_c, {k: v for k, v in CUSTOMERS.items() if "2026-01" in k})
    write_products(land_p, {k: v for k, v in PRODUCTS.items() if "2026-01" in k})
    assert check()["dim_customers_type2"].count() == 3
    write_customers(land_c, {k: v for k, v in CUSTOMERS.items() if "2026-06" in k})
    write_products(land_p, {k: v for k, v in PRODUCTS.items() if "2026-06" in k})
    assert check()["dim_customers_type2"].count() == 6
    # a late March batch: John moved in between
    os.makedirs(land_c, exist_ok=True)
    with open(f"{land_c}/customers_2026-03.json", "w") as f:
        f.write(json.dumps({"customer_id": "101", "name": "John", "city": "Oakland",
                            "event_date": "2026-03-01"}) + "\n")
    # a run that stopped right after ingesting: the next run must still stage it
    from strata.streaming.bronze import ingest
    ingest(spark, landing.customers, f"{lake}/bronze/customers", f"{lake}/_checkpoints/customers",
           f"{lake}/_schemas/customers")
    out = check()
    john = sorted((r.valid_from, r.city) for r in out["dim_customers_type2"].filter("customer_id = 101").collect())
    assert [c for _, c in john] == ["San Francisco", "Oakland", "Mountain View"]


def test_command_line_run(workdir, tmp_path):
    import json
    import subprocess
    import sys as _sys
    from pathlib import Path
    root = Path(__file__).resolve().parents[1]
    land_dir = tmp_path / "land"  # tiny fixture files for the child process
    write_customers(str(land_dir / "customers"))
    write_products(str(land_dir / "products"))
    out = subprocess.run([_sys.executable, "-m", "strata", "run", "--customers", str(land_dir / "customers"),
                          "--products", str(land_dir / "products"), "--root", f"{workdir}/cli",
                          "--as-of", "2026-07-01", "--master", "local[2]"],
                         cwd=root, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    counts = json.loads(out.stdout.strip().splitlines()[-1])
    assert counts["silver/dim_customers_type2"] == 6 and counts["silver/dim_products_type2"] == 7
    inc = subprocess.run([_sys.executable, "-m", "strata", "run", "--customers", str(land_dir / "customers"),
                          "--products", str(land_dir / "products"), "--root", f"{workdir}/cli-inc",
                          "--as-of", "2026-07-01", "--master", "local[2]", "--incremental"],
                         cwd=root, capture_output=True, text=True, timeout=600)
    assert inc.returncode == 0, inc.stderr[-2000:]
    assert json.loads(inc.stdout.strip().splitlines()[-1]) == [
        "dim_customers_type1", "dim_customers_type2", "dim_products_type2"]


def test_parquet_column_widens(spark, workdir):
    from pyspark.sql import functions as F
    from strata.sources.landing import land
    from strata.streaming.bronze import ingest, read_bronze
    spec = SourceSpec("o", "parquet", f"{workdir}/land")
    args = (f"{workdir}/b", f"{workdir}/c", f"{workdir}/s")
    land(spark.range(0, 5).select(F.col("id").cast("int").alias("qty"), F.lit("2026-01").alias("batch_key")),
         spec.path, "parquet")
    ingest(spark, spec, *args)
    big = spark.range(0, 5).select((F.col("id") + 3_000_000_000).alias("qty"), F.lit("2026-02").alias("batch_key"))
    land(big, spec.path, "parquet")
    ingest(spark, spec, *args)
    got = sorted(int(r.qty) for r in read_bronze(spark, f"{workdir}/b", f"{workdir}/s").collect())
    assert got == [0, 1, 2, 3, 4] + [3_000_000_000 + i for i in range(5)]


def test_nested_json_lands_as_json_text(spark, workdir):
    import json
    import os
    from strata.streaming.bronze import ingest, read_bronze
    os.makedirs(f"{workdir}/land", exist_ok=True)
    with open(f"{workdir}/land/customers_2026-01.json", "w") as f:
        f.write(json.dumps({"customer_id": "1", "address": {"city": "SF", "zip": "94105"}, "tags": ["a", "b"]}) + "\n")
    ingest(spark, SourceSpec("c", "json", f"{workdir}/land"), f"{workdir}/b", f"{workdir}/c", f"{workdir}/s")
    r = read_bronze(spark, f"{workdir}/b", f"{workdir}/s").first()
    assert json.loads(r.address) == {"city": "SF", "zip": "94105"} and json.loads(r.tags) == ["a", "b"]


def test_malformed_json_line_is_rejected_with_its_text(spark, workdir):
    import os
    from strata.plans.flow import MALFORMED, stage_customers
    from strata.streaming.bronze import ingest, read_bronze
    os.makedirs(f"{workdir}/land", exist_ok=True)
    with open(f"{workdir}/land/customers_2026-01.json", "w") as f:
        f.write('{"customer_id": "101", "name": "John", "city": "SF", "event_date": "2026-01-01"}\n')
        f.write('{"customer_id": "102", "name": "Mary", "city": \n')  # cut off
    ingest(spark, SourceSpec("c", "json", f"{workdir}/land"), f"{workdir}/b", f"{workdir}/c", f"{workdir}/s")
    good, bad = stage_customers(read_bronze(spark, f"{workdir}/b", f"{workdir}/s"))
    assert [r.customer_id for r in good.collect()] == [101]
    rej = bad.collect()
    assert len(rej) == 1 and rej[0].reject_reason == MALFORMED and '"Mary"' in rej[0]._corrupt_record
