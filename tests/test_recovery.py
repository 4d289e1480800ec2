"""The daily run, stopped anywhere, leaves the tables of a rebuild in the end."""

import json
import os

import pytest

from sample import CUSTOMERS, PRODUCTS, write_customers, write_products
from strata.operators import publish as P
from strata.operators import scd
from strata.plans import flow
from strata.plans.flow import Landing, run_incremental, run_layers
from strata.session import delete_path, move_path, names_below, path_exists, write_text
from strata.streaming.bronze import SourceSpec
from test_incremental import DROPS, TABLES, land_orders, rows


class Stop(Exception):
    pass


@pytest.fixture()
def landing(workdir):
    land = f"{workdir}/land"
    return Landing(SourceSpec("customers", "json", f"{land}/customers"), SourceSpec("products", "csv", f"{land}/products"),
                   SourceSpec("orders", "parquet", f"{land}/orders/in"))


def drop(spark, landing, n):
    month = ["2026-01", "2026-06", None][n]
    if month:
        write_customers(landing.customers.path, {k: v for k, v in CUSTOMERS.items() if month in k})
        write_products(landing.products.path, {k: v for k, v in PRODUCTS.items() if month in k})
    else:  # a late batch, and one that is delivered again with another city
        for name, city in (("customers_2026-03", "Oakland"), ("customers_2026-06_again", "Zurich")):
            with open(f"{landing.customers.path}/{name}.json", "w") as f:
                f.write(json.dumps({"customer_id": "101", "name": "John", "city": city, "event_date": "2026-06-02"}) + "\n")
    land_orders(spark, landing.orders.path.removesuffix("/in"), DROPS[n])


def test_a_stop_before_any_step_is_made_good(spark, workdir, landing):
    steps = []
    drop(spark, landing, 0)
    run_incremental(spark, landing, f"{workdir}/daily", as_of="2026-07-01", on_step=steps.append)
    assert len(steps) == len(set(steps)) == 13

    def stop_at(step):
        def on_step(name):
            if name == step:
                raise Stop(name)
        return on_step

    for n in (1, 2):
        drop(spark, landing, n)
        for step in steps[1 + n::2]:
            with pytest.raises(Stop):
                run_incremental(spark, landing, f"{workdir}/daily", as_of="2026-07-01", on_step=stop_at(step))
        run_incremental(spark, landing, f"{workdir}/daily", as_of="2026-07-01")
        run_layers(spark, landing, f"{workdir}/full{n}", as_of="2026-07-01")
        for t in TABLES:
            assert rows(spark, f"{workdir}/daily/{t}") == rows(spark, f"{workdir}/full{n}/{t}"), (n, t)


def test_a_stop_inside_a_step_is_made_good(spark, workdir, landing, monkeypatch):
    """Runs end after a few file operations each, wherever that is: inside a
    publish, between a table and its record, in a state's commit."""
    left = [10**9]

    def limited(operation):
        def run(*args, **kw):
            left[0] -= 1
            if left[0] < 0:
                raise Stop(operation.__name__)
            return operation(*args, **kw)
        return run

    for module, names in ((P, (delete_path, move_path, write_text)), (scd, (delete_path,))):
        for f in names:
            monkeypatch.setattr(module, f.__name__, limited(f))
    drop(spark, landing, 0)
    run_incremental(spark, landing, f"{workdir}/daily", as_of="2026-07-01")
    for n, budgets in ((1, (2, 17, 23, 31, 12, 26, 38, 15, 29)), (2, (5, 19, 11, 33, 24, 16, 41))):
        drop(spark, landing, n)
        stops = 0
        for budget in budgets:
            left[0] = budget
            try:
                run_incremental(spark, landing, f"{workdir}/daily", as_of="2026-07-01")
            except Stop:
                stops += 1
        left[0] = 10**9
        run_incremental(spark, landing, f"{workdir}/daily", as_of="2026-07-01")
        assert stops > 3
        run_layers(spark, landing, f"{workdir}/full{n}", as_of="2026-07-01")
        for t in TABLES:
            assert rows(spark, f"{workdir}/daily/{t}") == rows(spark, f"{workdir}/full{n}/{t}"), (n, t)
        assert not [x for d in ("silver", "gold", "state") for x in names_below(spark, f"{workdir}/daily/{d}") if x.endswith(P.READY)]


def test_nothing_pending_does_nothing(spark, workdir, landing, monkeypatch):
    drop(spark, landing, 0)
    run_incremental(spark, landing, f"{workdir}/daily", as_of="2026-07-01")
    monkeypatch.setattr(flow, "publish", lambda *a, **k: pytest.fail("published"))
    monkeypatch.setattr(scd, "catch_up", lambda *a, **k: pytest.fail("applied"))
    out = run_incremental(spark, landing, f"{workdir}/daily", as_of="2026-07-01")
    assert out["sales_by_city"].count() > 0


def test_publish_replaces_whole_tables_and_partitions(spark, workdir):
    path = f"{workdir}/t"

    def table(*r):
        return spark.createDataFrame(list(r), "k string, v long")

    P.publish(table(("a", 1), ("b", 2), ("c d/e", 3), (None, 4)), path, ["k"])
    now = P.publish(table(("a", 10), (None, 40)), path, ["k"], replace=[{"k": "a"}, {"k": None}, {"k": "c d/e"}, {"k": "new"}])
    assert sorted(map(tuple, now.collect()), key=str) == sorted([("a", 10), ("b", 2), (None, 40)], key=str)
    with pytest.raises(ValueError, match="outside"):
        P.publish(table(("b", 1)), path, ["k"], replace=[{"k": "a"}])
    # a table may be made from the one it replaces
    now = P.publish(now.selectExpr("k", "v + 1 AS v"), path, ["k"])
    assert sorted(r.v for r in now.collect()) == [3, 11, 41]
    assert P.publish(table(), path, ["k"]).count() == 0


@pytest.mark.parametrize("after", range(6))
def test_publish_stopped_is_completed_or_undone(spark, workdir, monkeypatch, after):
    path, left = f"{workdir}/t", [10**9]
    old, new = spark.range(3), spark.range(10, 14)
    P.publish(old, path)

    def limited(operation):
        def run(*args):
            left[0] -= 1
            if left[0] < 0:
                raise Stop
            return operation(*args)
        return run

    for f in (delete_path, move_path, write_text):
        monkeypatch.setattr(P, f.__name__, limited(f))
    left[0] = after
    try:
        P.publish(new, path)
    except Stop:
        left[0] = 10**9
        P.recover(spark, path)
    found = sorted(r.id for r in spark.read.parquet(path).collect())
    assert found == ([0, 1, 2] if after == 0 else [10, 11, 12, 13])
    assert not path_exists(spark, path + P.READY)


def test_progress_keeps_the_last_whole_value(spark, workdir):
    p = P.Progress(spark, f"{workdir}/p")
    assert p.read() == {}
    for k in range(3):
        p.write({"k": k})
    write_text(spark, f"{workdir}/p/00000009.tmp", "{broken")
    assert p.read() == {"k": 2} and len([n for n in os.listdir(f"{workdir}/p".removeprefix("file:")) if n.endswith(".json")]) == 1


def test_sums_read_only_the_months_that_changed(spark, workdir):
    from test_plans import plan
    fact = spark.range(100).selectExpr("id AS order_id", "id % 7 AS customer_id", "CAST(id AS DOUBLE) AS amount", "2026 AS year", "CAST(id % 5 AS INT) AS month")
    P.publish(fact, f"{workdir}/fact", flow.MONTH)
    back = P.read_table(spark, f"{workdir}/fact", fact)
    text = plan(flow.gold.sums_per(back.filter(flow._in_months(["2026-3"])), "customer_id", "amount", "order_id", flow.MONTH))
    assert "PartitionFilters: [" in text and "3)" in text.split("PartitionFilters: [")[1].split("]")[0]
