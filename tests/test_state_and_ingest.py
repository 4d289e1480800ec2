"""State that survives broken commits and late batches; ingest that loses nothing."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from strata.operators import clean as C
from strata.operators import layout, scd
from strata.operators.gold import sales_by
from strata.session import delete_path, has_data, shared_root
from strata.streaming.bronze import SourceSpec, discover_batches, ingest, read_bronze

D = dt.date
SCHEMA = "k long, v string, eff date, batch_key string"


def history(df):
    return sorted((tuple(r) for r in df.select("k", "v", "valid_from", "valid_to", "is_current").collect()), key=repr)


def rebuilt(staged):
    return history(scd.scd2(staged, ["k"], ["v"], "eff"))


def batches(seed, n=6, keys=10):
    rnd = random.Random(seed)
    return [(k, rnd.choice("abc"), D(2026, m, 1), f"2026-{m:02d}") for m in range(1, n + 1) for k in rnd.sample(range(keys), 6)]


def test_late_batch_after_a_base(spark, workdir):
    staged = spark.createDataFrame(batches(1), SCHEMA)
    state = scd.Scd2State(spark, f"{workdir}/s", ["k"], ["v"], "eff")
    early = staged.filter("batch_key != '2026-02'")
    scd.catch_up(spark, early, state)
    state.consolidate("2026-04")
    assert state.bases() == ["2026-04"] and history(state.history_at("2026-06")) == rebuilt(early)
    assert scd.catch_up(spark, staged, state) == [f"2026-{m:02d}" for m in range(2, 7)]
    assert state.bases() == [] and history(state.history_at("2026-06")) == rebuilt(staged)


def test_a_batch_without_its_record_is_applied_again(spark, workdir):
    staged = spark.createDataFrame(batches(2), SCHEMA)
    state = scd.Scd2State(spark, f"{workdir}/s", ["k"], ["v"], "eff")
    scd.catch_up(spark, staged, state)
    # a commit broken off: data there (one file less), no record
    delete_path(spark, f"{workdir}/s_commits/batch_key=2026-05")
    files = [f for d, _, names in os.walk(f"{workdir}/s/batch_key=2026-05".removeprefix("file:")) for f in (os.path.join(d, n) for n in names)
             if f.endswith(".parquet")]
    delete_path(spark, files[0])
    assert "2026-05" not in state.applied()
    assert scd.catch_up(spark, staged, state) == ["2026-05", "2026-06"]
    assert history(state.history_at("2026-06")) == rebuilt(staged)


def test_unchanged_batch_writes_no_rows(spark, workdir):
    rows = [(k, "a", D(2026, 1, 1), "2026-01") for k in range(5)] + [(k, "a", D(2026, 2, 1), "2026-02") for k in range(5)]
    state = scd.Scd2State(spark, f"{workdir}/s", ["k"], ["v"], "eff")
    scd.catch_up(spark, spark.createDataFrame(rows, SCHEMA), state)
    assert state.applied() == ["2026-01", "2026-02"]
    assert has_data(spark, f"{workdir}/s/batch_key=2026-01") and not has_data(spark, f"{workdir}/s/batch_key=2026-02")
    assert [(r.closed, r.opened, r.current) for r in state.log().collect()] == [(0, 5, 5), (0, 0, 5)]


@pytest.mark.parametrize("kind", ["scd1", "scd2"])
def test_every_batch_reads_as_it_was(spark, workdir, kind):
    staged = spark.createDataFrame(batches(3), SCHEMA)
    root = f"{workdir}/{kind}"
    state = scd.Scd1State(spark, root, ["k"], ["v"], "eff") if kind == "scd1" else scd.Scd2State(spark, root, ["k"], ["v"], "eff")
    scd.catch_up(spark, staged, state, fold_every=4)
    assert state.bases()
    for b in state.applied():
        upto = staged.filter(F.col("batch_key") <= b)
        if kind == "scd1":
            want, got = scd.scd1(upto, ["k"], ["v"], "eff"), state.snapshot_at(b)
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
        else:
            assert history(state.history_at(b)) == rebuilt(upto)


def test_a_version_without_a_date_is_still_closed(spark):
    rows = [(1, "a", D(2026, 1, 1), "2026-01"), (1, "b", None, "2026-02"), (1, "c", D(2026, 3, 1), "2026-03")]
    got = scd.scd2(spark.createDataFrame(rows, SCHEMA), ["k"], ["v"], "eff")
    assert [r.v for r in got.filter("is_current").collect()] == ["c"]


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


def drain(spark, spec, workdir):
    args = (f"{workdir}/b", f"{workdir}/c", f"{workdir}/s")
    ingest(spark, spec, *args)
    return read_bronze(spark, args[0], args[2])


def test_json_keys_are_rescued_and_then_columns(spark, workdir):
    folder = f"{workdir}/land zone+1"
    spec = SourceSpec("c", "json", folder)
    put(folder, "c 2026-01.json", '{"id": "1", "epoch": 7, "batch_key": "mine", "nested": {"a": [1, 2]}}\n\n{"id": \n')
    first = drain(spark, spec, workdir)
    row = first.filter("id = '1'").first()
    assert (row.epoch, row.source_batch_key, row.batch_key) == ("7", "mine", "2026-01")
    assert json.loads(row.nested) == {"a": [1, 2]} and row._rescued_data is None
    assert [r._corrupt_record.strip() for r in first.filter("_corrupt_record IS NOT NULL").collect()] == ['{"id":']
    # a file with a new key, a struct that gained a field and a type that changed
    put(folder, "c[2] 2026-02.json", '{"id": 2, "tier": "gold", "nested": {"a": "x", "b": null}}\n')
    both = drain(spark, spec, workdir)
    assert {(r.id, r.tier) for r in both.filter("id IS NOT NULL").collect()} == {("1", None), ("2", "gold")}
    assert both.filter("_rescued_data IS NOT NULL").count() == 0
    assert drain(spark, spec, workdir).count() == 3


def test_json_multi_line(spark, workdir):
    folder = f"{workdir}/land"
    put(folder, "a_2026-01.json", '[{"id": 1},\n {"id": 2, "x": {"y": 1}}]')
    put(folder, "b_2026-01.json", '{"id": 3,\n "x": null}')
    got = drain(spark, SourceSpec("m", "json", folder, {"multiLine": "true"}), workdir)
    assert sorted(r.id for r in got.collect()) == ["1", "2", "3"]


def test_ragged_csv_lines_keep_their_text(spark, workdir):
    folder = f"{workdir}/la nd"
    put(folder, "p 2026-01.csv", 'a,b\n1,2\n3,4,5\n6\n"x,y",7\n')
    put(folder, "p[1] 2026-02.csv", "b,epoch,a\n2,9,1\n")
    got = drain(spark, SourceSpec("p", "csv", folder), workdir).collect()
    assert {(r.a, r.b, r.epoch) for r in got if not r._corrupt_record} == {("1", "2", None), ("x,y", "7", None), ("1", "2", "9")}
    assert sorted(r._corrupt_record for r in got if r._corrupt_record) == ["3,4,5", "6"]


def test_csv_options(spark, workdir):
    folder = f"{workdir}/land"
    put(folder, "p_2026-01.csv", "a;b\n1;'x;y'\n")
    got = drain(spark, SourceSpec("p", "csv", folder, {"delimiter": ";", "quote": "'"}), workdir).first()
    assert (got.a, got.b) == ("1", "x;y")


def test_parquet_types_of_one_drop_differ(spark, workdir):
    folder = f"{workdir}/land"
    spark.range(3).select(F.col("id").cast("int").alias("n"), F.struct(F.lit(1).alias("a")).alias("s")).write.parquet(f"{folder}/x_2026-01")
    spark.range(3).select((F.col("id") + 2**40).alias("n"), F.struct(F.lit(1).alias("a"), F.lit("z").alias("b")).alias("s")).write.parquet(f"{folder}/y")
    got = drain(spark, SourceSpec("o", "parquet", folder), workdir)
    assert sorted(int(r.n) for r in got.collect()) == [0, 1, 2, 2**40, 2**40 + 1, 2**40 + 2]


def test_clean_rejects_what_is_not_an_amount(spark):
    raw = spark.createDataFrame([("1", "Infinity"), ("2", "1e20"), ("3", "NaN"), ("4", "0.001"), ("5", "-1")], "id string, amount string")
    good, bad = C.clean(raw, {"id": "bigint", "amount": "double"}, [C.positive("amount"), C.amount_in_range("amount")], raw_cols=["id"])
    assert [r.id for r in good.collect()] == [4]
    assert sorted(r.id for r in bad.collect()) == ["1", "2", "3", "5"]
    fact = spark.createDataFrame([(1, 1, 0.001), (2, 1, 1e20), (3, 1, float("inf"))], "o long, k long, amount double")
    out = sales_by(fact, spark.createDataFrame([(1, "x")], "k long, city string"), "k", ["city"], "amount", "o").first()
    assert (out.total_orders, out.total_amount) == (3, 1e20 + 0.001)


def test_no_batch_is_an_error(spark):
    none = spark.createDataFrame([(None,), ("",)], "batch_key string")
    with pytest.raises(ValueError, match="no batch"):
        discover_batches(none, none, required=True)


def test_empty_tables_can_be_read(spark, workdir):
    from strata.sources.schemas import SCHEMAS, ensure_all, read_table
    paths = ensure_all(spark, f"{workdir}/t")
    assert ensure_all(spark, f"{workdir}/t") == paths  # again: nothing to do
    for name, (schema, _) in SCHEMAS.items():
        got = read_table(spark, paths[name], schema)
        assert got.count() == 0 and got.columns == schema.names


def test_compaction_of_partitions_and_of_long_strings(spark, workdir):
    df = spark.range(4000).select(F.format_string("Customer#%09d", "id").alias("name"), (F.col("id") % 5).alias("p"),
                                  (F.col("id") * 7 % 1000).alias("b"))
    df.repartition(30).write.partitionBy("p").parquet(f"{workdir}/raw")
    raw = spark.read.parquet(f"{workdir}/raw")
    layout.compact(raw, f"{workdir}/packed", by=["name", "b"], partition_by=["p"])
    packed = spark.read.parquet(f"{workdir}/packed")
    assert len(packed.inputFiles()) <= len(raw.inputFiles()) / 5
    assert packed.select(*raw.columns).exceptAll(raw).count() == 0 and packed.count() == 4000
    # names that share a long prefix fall into different buckets
    assert raw.select(layout.zorder_key(raw, ["name", "b"]).alias("z")).distinct().count() >= 200
    layout.write_partitioned(df.filter("p = 1"), f"{workdir}/packed", ["p"], dynamic=True, gather=True)
    assert spark.read.parquet(f"{workdir}/packed").count() == 4000


def test_shared_root_needs_shared_storage():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(Session())


def test_names_that_differ_in_case_are_one_column(spark, workdir):
    folder = f"{workdir}/land"
    spec = SourceSpec("c", "json", folder)
    put(folder, "a_2026-01.json", '{"Id": 1, "a.b": "x", "": "none", "t`k": 5}\n{"id": 2, "ID": 3, "Id": null}\n')
    first = drain(spark, spec, workdir)
    assert [c for c in first.columns if c.lower() == "id"] == ["ID"]  # in order of name
    assert sorted(r["ID"] for r in first.collect()) == ["1", "3"]
    assert [json.loads(r._rescued_data) for r in first.filter("_rescued_data IS NOT NULL").collect()] == [{"id": "2"}]
    row = first.filter("ID = '1'").first()
    assert (row["a.b"], row["source_"], row["t`k"]) == ("x", "none", "5")
    put(folder, "b_2026-02.json", '{"iD": 4, "A.B": "y"}\n{"id": 5, "iD": 6, "new": 1}\n{"id": 7, "iD": 7, "new": null}\n')
    both = drain(spark, spec, workdir)
    assert sorted(r["ID"] for r in both.collect()) == ["1", "3", "4", "5", "7"]
    assert {r["a.b"] for r in both.collect()} == {"x", "y", None}
    assert sorted(json.loads(r._rescued_data).popitem() for r in both.filter("_rescued_data IS NOT NULL").collect()) == [("iD", "6"), ("id", "2")]
    put(folder, "c_2026-03.json", '{"id": 8, "iD": 9, "NEW": 2}\n')
    last = drain(spark, spec, workdir).filter("batch_key = '2026-03'").first()
    assert (last["ID"], last["new"], json.loads(last._rescued_data)) == ("8", "2", {"iD": "9"})


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_typed_columns_that_differ_in_case(spark, workdir, fmt):
    folder = f"{workdir}/land"
    spark.range(2).selectExpr("id", "'x' AS `a.b`").write.format(fmt).save(f"{folder}/x_2026-01")
    spec = SourceSpec("t", fmt, folder)
    assert drain(spark, spec, workdir).count() == 2
    spark.range(10, 12).selectExpr("CAST(id AS INT) AS ID", "'y' AS `A.b`").write.format(fmt).save(f"{folder}/y_2026-02")
    got = drain(spark, spec, workdir)
    assert sorted((r.id, r["a.b"]) for r in got.collect()) == [("0", "x"), ("1", "x"), ("10", "y"), ("11", "y")]


def test_csv_headers_that_differ_in_case(spark, workdir):
    folder = f"{workdir}/land"
    put(folder, "a_2026-01.csv", "Id,a.b\n1,x\n")
    put(folder, "b_2026-01.csv", "A.B,id\ny,2\n")
    got = drain(spark, SourceSpec("c", "csv", folder), workdir)
    column = {c.lower(): c for c in got.columns}
    assert sorted((r[column["id"]], r[column["a.b"]]) for r in got.collect()) == [("1", "x"), ("2", "y")]


def test_manifest_and_a_retried_micro_batch(spark, workdir):
    from strata.session import delete_path
    from strata.streaming.bronze import manifest, new_files
    folder = f"{workdir}/land"
    spec = SourceSpec("c", "json", folder)
    put(folder, "a 2026-01.json", '{"id": 1}\n')
    put(folder, "empty_2026-01.json", "")
    drain(spark, spec, workdir)
    put(folder, "b_2026-02.json", '{"id": 2}\n{"id": 3}\n')
    assert [n.rpartition("/")[2] for n in new_files(spark, spec, f"{workdir}/b")] == ["b_2026-02.json"]
    drain(spark, spec, workdir)
    delete_path(spark, f"{workdir}/c/commits/1")  # as if the run had ended before its commit
    again = drain(spark, spec, workdir)
    assert sorted(r.id for r in again.collect()) == ["1", "2", "3"]
    files = manifest(spark, f"{workdir}/b").collect()
    assert sorted((r.file.rpartition("/")[2], r.epoch) for r in files) == [("a 2026-01.json", 0), ("b_2026-02.json", 1)]
    assert all(r.modified is not None for r in files) and sum(r.bytes for r in files) == 30


@pytest.mark.parametrize("fmt", ["json", "parquet", "csv"])
def test_a_run_reads_no_older_bronze_and_no_older_file(spark, workdir, fmt):
    """Old data that cannot be read doesn't disturb a later drop."""
    folder = f"{workdir}/land"
    df = spark.range(3).withColumn("v", F.lit("x")).coalesce(1)

    def drop(month):
        w = df.write.option("header", "true") if fmt == "csv" else df.write
        w.format(fmt).save(f"{folder}/batch_key={month}")

    spec, args = SourceSpec("t", fmt, folder), (f"{workdir}/b", f"{workdir}/c", f"{workdir}/s")
    drop("2026-01")
    ingest(spark, spec, *args)
    local = workdir.removeprefix("file:")
    for top, suffix in ((f"{local}/b", ".parquet"), (f"{local}/land", f".{fmt}")):
        for d, _, names in os.walk(top):
            for n in names:
                if n.endswith(suffix):
                    os.remove(f"{d}/.{n}.crc")
                    with open(f"{d}/{n}", "wb") as f:
                        f.write(b"\x00broken")
    drop("2026-02")
    ingest(spark, spec, *args)
    assert read_bronze(spark, args[0], args[2]).filter("batch_key = '2026-02'").count() == 3
