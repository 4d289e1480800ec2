"""The incremental run leaves the same tables as a rebuild, drop after drop."""

import json
import os

import pytest

from sample import CUSTOMERS, PRODUCTS, write_customers, write_products
from strata.plans.flow import GOLD, Landing, run_incremental, run_layers
from strata.session import has_data
from strata.streaming.bronze import SourceSpec

ORDER_SCHEMA = "order_id string, customer_id string, product_id string, amount string, order_date string"
DROPS = [
    {"2026-01": [("1", "101", "P001", "999.0", "2026-01-10"), ("2", "102", "P003", "29.9", "2026-01-11"),
                 ("3", "103", "P002", "2499.0", "2026-02-12"), ("x", "101", "P001", "5", "2026-01-01"), ("8", "101", "P001", "Infinity", "2026-01-01")]},
    # order 3 is re-sent with another date: it leaves February, which becomes empty
    {"2026-06": [("3", "103", "P002", "2400.0", "2026-06-02"), ("5", "104", "P005", "199.0", "2026-06-02"), ("6", "101", None, "1", "2026-06-02")]},
    # a late batch, one order older than what has been sent, and a row without a batch
    {"2026-03": [("1", "101", "P001", "998.0", "2026-03-10"), ("2", "102", "P003", "30.0", "2026-01-11"), ("5", "104", "P005", "1.0", "2026-03-01")],
     "none": [("9", "101", "P001", "1", "2026-01-01")]},
]
TABLES = [*(f"silver/{t}" for t in ("stg_customers", "stg_products", "stg_orders", "rejects_customers", "rejects_products", "rejects_orders",
                                    "dim_customers_type1", "dim_customers_type2", "dim_products_type2", "fact_orders")), *GOLD]


def land_orders(spark, folder, drop):
    for batch, rows in drop.items():
        spark.createDataFrame(rows, ORDER_SCHEMA).coalesce(1).write.parquet(f"{folder}/tmp_{batch}")
        os.makedirs(folder, exist_ok=True)
        part = next(n for n in os.listdir(f"{folder}/tmp_{batch}") if n.endswith(".parquet"))
        target = f"{folder}/in"
        os.makedirs(target, exist_ok=True)
        os.link(f"{folder}/tmp_{batch}/{part}", f"{target}/orders_{batch}.parquet")


def rows(spark, path):
    if not has_data(spark, path):
        return []
    df = spark.read.parquet(path)
    return sorted((tuple(str(r[c]) for c in sorted(df.columns)) for r in df.collect()))


def test_incremental_equals_rebuild(spark, workdir):
    land = f"{workdir}/land"
    landing = Landing(SourceSpec("customers", "json", f"{land}/customers"), SourceSpec("products", "csv", f"{land}/products"),
                      SourceSpec("orders", "parquet", f"{land}/orders/in"))
    months = ["2026-01", "2026-06", None]
    for n, (drop, month) in enumerate(zip(DROPS, months, strict=True)):
        if month:
            write_customers(f"{land}/customers", {k: v for k, v in CUSTOMERS.items() if month in k})
            write_products(f"{land}/products", {k: v for k, v in PRODUCTS.items() if month in k})
        else:
            with open(f"{land}/customers/customers_2026-03.json", "w") as f:
                f.write(json.dumps({"customer_id": "101", "name": "John", "city": "Oakland", "event_date": "2026-03-01"}) + "\n")
            write_products(f"{land}/products", {"products_nokey.csv": [("P009", "Lost", "X", "1", "2026-01-01")],
                                                "products_2026-13.csv": [("P001", "iPhone 15", "X", "1", "2026-01-01")]})
        land_orders(spark, f"{land}/orders", drop)
        run_incremental(spark, landing, f"{workdir}/daily", as_of="2026-07-01", fold_every=2)
        run_layers(spark, landing, f"{workdir}/full{n}", as_of="2026-07-01")
        for t in TABLES:
            assert rows(spark, f"{workdir}/daily/{t}") == rows(spark, f"{workdir}/full{n}/{t}"), (n, t)
    reasons = {r.reject_reason for r in spark.read.parquet(f"{workdir}/daily/silver/rejects_products").collect()}
    assert reasons == {"batch_key is null or not parseable", "business_date is null or not parseable"}
    assert not os.path.exists(f"{workdir}/daily/silver/fact_orders/year=2026/month=2".removeprefix("file:"))


@pytest.mark.parametrize("run", [run_layers, run_incremental])
def test_a_source_that_is_rejected_whole(spark, workdir, run):
    write_customers(f"{workdir}/land/customers", {"customers_2026-01.json": [("abc", "John", "SF", "2026-01-01")]})
    write_products(f"{workdir}/land/products", {"products_2026-01.csv": [("P1", "x", "y", "-1", "2026-01-01")]})
    landing = Landing(SourceSpec("customers", "json", f"{workdir}/land/customers"), SourceSpec("products", "csv", f"{workdir}/land/products"))
    run(spark, landing, f"{workdir}/lake", as_of="2026-07-01")
    assert len(rows(spark, f"{workdir}/lake/silver/rejects_customers")) == 1
    assert rows(spark, f"{workdir}/lake/silver/dim_customers_type2") == []


@pytest.mark.parametrize("run", [run_layers, run_incremental])
def test_no_batch_stops_with_a_message(spark, workdir, run):
    landing = Landing(SourceSpec("customers", "json", f"{workdir}/none/c"), SourceSpec("products", "csv", f"{workdir}/none/p"))
    with pytest.raises(ValueError, match="no batch"):
        run(spark, landing, f"{workdir}/lake", as_of="2026-07-01")
