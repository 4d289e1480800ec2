
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from strata.functions.columns import batch_key_of, business_date
from strata.operators import access, checks, layout, merge, scd
from strata.operators import clean as C
from strata.operators.asof import pit_join, state_on
from strata.streaming.bronze import discover_batches

D = dt.date
SCHEMA = "k long, v string, eff date, batch_key string"


def _staged(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _random_batches(seed, keys=12, batches=8):
    rnd = random.Random(seed)
    rows = []
    for b in range(batches):
        day = D(2026, 1, 1) + dt.timedelta(days=7 * b)
        for k in rnd.sample(range(keys), rnd.randint(1, keys)):
            rows.append((k, rnd.choice(["a", "b", "c", None]), day, day.isoformat()))
    return rows


def _hist(spark, rows):
    return scd.scd2(_staged(spark, rows), ["k"], ["v"], "eff")


def _set(df):
    rows = df.select("k", "v", "valid_from", "valid_to", "is_current").collect()
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_replay_equals_rebuild_and_rerun_is_same(spark, workdir, seed):
    rows = _random_batches(seed)
    staged = _staged(spark, rows)
    batches = sorted({r[3] for r in rows})
    state = scd.Scd2State(spark, f"{workdir}/s{seed}", ["k"], ["v"], "eff")
    replayed = scd.replay(spark, staged.withColumnRenamed("x", "x"), batches, state)
    rebuilt = scd.scd2(staged, ["k"], ["v"], "eff")
    assert _set(replayed) == _set(rebuilt)
    again = scd.replay(spark, staged, batches, state)  # rerun every batch
    assert _set(again) == _set(rebuilt)
    # prefix: state after batch 3 equals a rebuild over batches <= 3
    assert _set(state.history_at(batches[3])) == _set(scd.as_of_batch(staged, batches[3], ["k"], ["v"], "eff"))
    dims = {"d": (rebuilt, "k")}
    assert checks.current_version_violations(dims).count() == 0
    assert checks.open_interval_violations(dims).count() == 0
    assert checks.interval_violations(dims).count() == 0


def test_late_batch_equals_in_order(spark):
    rows = _random_batches(7)
    shuffled = list(reversed(rows))  # arrival order does not matter
    assert _set(_hist(spark, shuffled)) == _set(_hist(spark, rows))


def test_null_is_a_change_and_a_b_a(spark):
    rows = [(1, None, D(2026, 1, 1), "2026-01"), (1, "x", D(2026, 2, 1), "2026-02"),
            (2, "a", D(2026, 1, 1), "2026-01"), (2, "b", D(2026, 2, 1), "2026-02"),
            (2, "a", D(2026, 3, 1), "2026-03"), (3, "a", D(2026, 1, 1), "2026-01"),
            (3, "a", D(2026, 3, 1), "2026-03")]
    h = _hist(spark, rows)
    got = {k: [r.v for r in sorted(h.filter(F.col("k") == k).collect(), key=lambda r: r.valid_from)]
           for k in (1, 2, 3)}
    assert got == {1: [None, "x"], 2: ["a", "b", "a"], 3: ["a"]}


def test_half_open_and_zero_length_versions(spark):
    rows = [(1, "a", D(2026, 1, 1), "2026-01"), (1, "b", D(2026, 6, 1), "2026-06"),
            (1, "c", D(2026, 6, 1), "2026-07")]  # same effective date twice
    h = _hist(spark, rows)
    assert h.count() == 3
    assert [r.v for r in state_on(h, "2026-01-01").collect()] == ["a"]
    assert [r.v for r in state_on(h, "2026-05-31").collect()] == ["a"]
    # on the closing day the newer version holds; the zero-length one never does
    assert [r.v for r in state_on(h, "2026-06-01").collect()] == ["c"]


def test_pit_join_picks_valid_version(spark):
    dim = spark.createDataFrame([("P001", 999.0, D(2026, 1, 1), D(2026, 6, 1), False),
                                 ("P001", 899.0, D(2026, 6, 1), None, True)],
                                "product_id string, price double, valid_from date, valid_to date, is_current boolean")
    fact = spark.createDataFrame([(1, "P001", D(2026, 2, 10)), (2, "P001", D(2026, 6, 15)),
                                  (3, "P001", D(2025, 12, 1))], "order_id int, product_id string, order_date date")
    got = {r.order_id: r.price for r in pit_join(fact, dim, ["product_id"], "order_date", "left").collect()}
    assert got == {1: 999.0, 2: 899.0, 3: None}


def test_clean_rejects_dirty_input_without_raising(spark):
    raw = spark.createDataFrame([
        ("101", "John", "SF", "2026-01-01"), ("abc", "X", "SF", "2026-01-01"),
        ("102", "Mary", "SJ", "2026-02-31"), ("103", None, "PA", "2026-01-01"),
        ("104", "Anna", "SV", "2026-01-01"), ("104", "Anna", "MV", "2026-01-02")],
        "customer_id string, name string, city string, event_date string")
    good, bad = C.clean(raw, {"customer_id": "bigint", "name": "string", "city": "string",
                              "event_date": "date:yyyy-MM-dd"},
                        [C.not_null("customer_id"), C.not_null("name"), C.not_null("event_date")],
                        key=["customer_id"], order=["event_date"], raw_cols=["customer_id"])
    assert {(r.customer_id, r.city) for r in good.collect()} == {(101, "SF"), (104, "MV")}
    assert {(r.customer_id, r.reject_reason) for r in bad.collect()} == {
        ("abc", "customer_id is null or not parseable"), ("102", "event_date is null or not parseable"),
        ("103", "name is null or not parseable")}


def test_fill_then_positive_rejects_null_amount(spark):
    raw = spark.createDataFrame([("1", None), ("2", "-5"), ("3", "7.5")], "order_id string, amount string")
    good, bad = C.clean(raw, {"order_id": "bigint", "amount": "double"}, [C.positive("amount")],
                        fill={"amount": 0.0}, raw_cols=["order_id"])
    assert [r.order_id for r in good.collect()] == [3]
    assert sorted(r.order_id for r in bad.collect()) == ["1", "2"]


def test_scd1_moves_update_date(spark):
    rows = [(103, "Palo Alto", D(2026, 1, 1), "2026-01"), (103, "Palo Alto", D(2026, 6, 1), "2026-06")]
    t1 = scd.scd1(_staged(spark, rows).withColumnRenamed("v", "city"), ["k"], ["city"], "eff").collect()
    assert [(r.city, r.update_date) for r in t1] == [("Palo Alto", D(2026, 6, 1))]


def test_upsert_and_update_matched(spark):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "id int, v string, n int")
    source = spark.createDataFrame([(2, "B"), (3, "C")], "id int, v string")
    out = merge.upsert(target, source, ["id"], {"v": "source.v"},
                       {"id": "source.id", "v": "source.v", "n": "0"})
    assert sorted(tuple(r) for r in out.collect()) == [(1, "a", 10), (2, "B", 20), (3, "C", 0)]
    upd = merge.update_matched(target, source, ["id"], {"n": "-1"})
    assert sorted(tuple(r) for r in upd.collect()) == [(1, "a", 10), (2, "b", -1)]


def test_batch_key_from_basename_and_all_sources(spark):
    df = spark.createDataFrame([("/raw/2025-12/customers_2026-01.json",), ("/raw/products_2026-03.csv",),
                                ("/raw/readme.txt",)], "p string")
    keys = [r.k for r in df.select(batch_key_of("p").alias("k")).collect()]
    assert keys == ["2026-01", "2026-03", None]
    c = spark.createDataFrame([("2026-01",)], "batch_key string")
    p = spark.createDataFrame([("2026-03",), ("2026-01",)], "batch_key string")
    assert [r.batch_key for r in discover_batches(c, p).collect()] == ["2026-01", "2026-03"]
    assert df.select(business_date(F.lit("2026-03")).alias("d")).first().d == D(2026, 3, 1)


def test_masks_and_row_filters(spark):
    h = spark.createDataFrame([(1, "John", True), (1, "John", False)], "id int, name string, is_current boolean")
    assert {r.name for r in access.mask_columns(h, ["name"], "data_engineers").collect()} == {"John"}
    assert {r.name for r in access.mask_columns(h, ["name"], "data_analysts").collect()} == {"XXXX"}
    assert access.restrict_rows(h, "data_engineers").count() == 2
    assert access.restrict_rows(h, "data_analysts").count() == 1
    access.register_sql_functions(spark)
    h.createOrReplaceTempView("h_tmp")
    r = spark.sql("SELECT mask_pii_name(name, 'data_analysts') AS n FROM h_tmp "
                  "WHERE filter_current_only(is_current, 'data_analysts')").collect()
    assert [x.n for x in r] == ["XXXX"]


def test_compaction_keeps_rows(spark, workdir):
    df = spark.range(0, 5000).select((F.col("id") % 97).alias("a"), (F.col("id") * 7 % 101).alias("b"), "id")
    layout.compact(df.repartition(40), f"{workdir}/z", by=["a", "b"], files=4)
    back = spark.read.parquet(f"{workdir}/z")
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0
    assert len(back.inputFiles()) <= 4


def test_ranking_top_n_is_total_order(spark):
    df = spark.createDataFrame([(i, float(i % 3)) for i in range(10)], "customer_id int, total_amount double")
    from strata.operators.gold import rank_top
    got = [(r.customer_id, r.ranking) for r in rank_top(df, "total_amount", "customer_id", 4).orderBy("ranking").collect()]
    assert got == [(2, 1), (5, 2), (8, 3), (1, 4)]


def test_ensure_table_never_replaces_data(spark, workdir):
    from strata.sources.schemas import SCHEMAS, ensure_all, ensure_table
    paths = ensure_all(spark, f"{workdir}/t")
    assert spark.read.parquet(paths["dim_customers_type2"]).count() == 0
    schema, _ = SCHEMAS["dim_customers_type1"]
    spark.createDataFrame([(1, "a", "b", D(2026, 1, 1))], schema).write.mode("append") \
        .parquet(paths["dim_customers_type1"])
    assert ensure_table(spark, paths["dim_customers_type1"], schema) is False
    assert spark.read.parquet(paths["dim_customers_type1"]).count() == 1


def test_apply_reports_counts_once(spark, workdir):
    rows = [(101, "SF", D(2026, 1, 1), "2026-01"), (102, "SJ", D(2026, 1, 1), "2026-01"),
            (101, "MV", D(2026, 6, 1), "2026-06"), (102, "SJ", D(2026, 6, 1), "2026-06"),
            (104, "SV", D(2026, 6, 1), "2026-06")]
    staged = _staged(spark, rows)
    st = scd.Scd2State(spark, f"{workdir}/c", ["k"], ["v"], "eff", log=True)
    first = st.apply("2026-01", staged.filter("batch_key = '2026-01'").drop("batch_key"), None)
    second = st.apply("2026-06", staged.filter("batch_key = '2026-06'").drop("batch_key"), "2026-01")
    assert first == {"closed": 0, "opened": 2, "current": 2}
    assert second == {"closed": 1, "opened": 2, "current": 3}
    again = st.apply("2026-06", staged.filter("batch_key = '2026-06'").drop("batch_key"), "2026-01")
    assert again == second
    log = [(r.batch_key, r.closed, r.opened, r.current) for r in st.log().collect()]
    assert log == [("2026-01", 0, 2, 2), ("2026-06", 1, 2, 3)]  # the rerun replaced its row


@pytest.mark.parametrize("how", ["inner", "left", "right", "outer", "left_semi", "left_anti"])
def test_skew_safe_joins_equal_plain_joins(spark, how):
    from strata.operators import joins
    dim = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k long, name string")
    # key 1 is hot; key 9 has no dimension row; key 3 has no facts
    fact = spark.createDataFrame([(1, i, float(i)) for i in range(50)] + [(2, 100, 1.0), (9, 101, 2.0)],
                                 "k long, order_id long, amount double")
    ours = {"inner": joins.inner, "left": joins.left_outer, "right": joins.right_outer,
            "outer": joins.full_outer, "left_semi": joins.semi, "left_anti": joins.anti}[how](dim, fact, "k")
    plain = dim.join(fact, "k", how)
    assert ours.columns == plain.columns
    assert ours.exceptAll(plain).count() == 0 and plain.exceptAll(ours).count() == 0


def test_catch_up_handles_late_batch(spark, workdir):
    rows = _random_batches(11, batches=6)
    staged = _staged(spark, rows)
    keys = sorted({r[3] for r in rows})
    late = keys[2]
    st = scd.Scd2State(spark, f"{workdir}/late", ["k"], ["v"], "eff")
    # everything but one batch arrives first
    assert scd.catch_up(spark, staged.filter(F.col("batch_key") != late), st) == [k for k in keys if k != late]
    assert scd.catch_up(spark, staged.filter(F.col("batch_key") != late), st) == []  # nothing pending
    # the late batch: it and every later batch are re-applied
    assert scd.catch_up(spark, staged, st) == keys[2:]
    assert _set(st.history_at(keys[-1])) == _set(scd.scd2(staged, ["k"], ["v"], "eff"))


def test_csv_header_found_when_files_are_split(spark, workdir):
    from sample import write_products
    from strata.streaming.bronze import SourceSpec, ingest, read_bronze
    many = {f"products_2026-0{m}.csv": [(f"P{m}{i:03d}", f"item {i}", "Cat", f"{i}.50", "2026-01-01")
                                         for i in range(300)] for m in (1, 2)}
    write_products(f"{workdir}/land", files=many, header=("price", "product_id", "product_name", "category",
                                                           "launch_date"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")  # several splits per file
    try:
        ingest(spark, SourceSpec("p", "csv", f"{workdir}/land"), f"{workdir}/b", f"{workdir}/c", f"{workdir}/s")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    b = read_bronze(spark, f"{workdir}/b", f"{workdir}/s")
    assert b.count() == 600
    assert b.filter(~F.col("product_id").startswith("P")).count() == 0  # no header rows, no swapped columns
    assert b.filter(F.col("price").endswith(".50")).count() == 600


@pytest.mark.parametrize("bucket", ["month", "year"])
def test_bucketed_pit_join_equals_plain(spark, bucket):
    rnd = random.Random(5)
    versions = []
    for k in range(6):
        day = D(2025, 1, 1)
        for _ in range(rnd.randint(1, 12)):
            nxt = day + dt.timedelta(days=rnd.randint(0, 60))  # zero-length versions too
            versions.append((k, float(rnd.randint(1, 99)), day, nxt))
            day = nxt
        versions.append((k, 0.5, day, None))
    dim = spark.createDataFrame([(k, p, a, b, b is None) for k, p, a, b in versions],
                                "k long, price double, valid_from date, valid_to date, is_current boolean")
    fact = spark.createDataFrame([(i, rnd.randint(0, 6), D(2024, 12, 1) + dt.timedelta(days=rnd.randint(0, 900)))
                                  for i in range(400)], "id long, k long, d date")
    for how in ("inner", "left"):
        plain = pit_join(fact, dim, ["k"], "d", how)
        bucketed = pit_join(fact, dim, ["k"], "d", how, bucket=bucket)
        assert plain.exceptAll(bucketed).count() == 0 and bucketed.exceptAll(plain).count() == 0


def test_consolidated_state_reads_the_same(spark, workdir):
    rows = _random_batches(21, batches=7)
    staged = _staged(spark, rows)
    keys = sorted({r[3] for r in rows})
    st = scd.Scd2State(spark, f"{workdir}/cons", ["k"], ["v"], "eff")
    scd.replay(spark, staged, keys, st)
    before = {b: _set(st.history_at(b)) for b in (keys[1], keys[4], keys[-1])}
    st.consolidate(keys[3])
    for b, want in before.items():
        assert _set(st.history_at(b)) == want  # before and after the base
    assert _set(st.history_at(keys[-1])) == _set(scd.scd2(staged, ["k"], ["v"], "eff"))
