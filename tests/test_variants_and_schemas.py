"""Whole records as VARIANT, declared against existing schemas, counts out of a write."""

import datetime as dt

from pyspark.sql import types as T

from strata.functions import variants as V
from strata.operators import checks
from strata.sources import schemas as S
from strata.streaming.bronze import SourceSpec, ingest, read_bronze
from test_state_and_ingest import put


def test_fields_take_keys_as_they_are(spark):
    lines = ['{"Id": 1, "a.b": "x", "": 5, "q\'\\"": true, "n": {"k": [1, 2.5]}}', '{"ID": "2", "id": "two", "n": null}', '{"iD": 3.5, "a.b": 7}',
             '[1]', '5', 'null', '{"x": 1, "x": 2}', '{broken', '', None]
    df = spark.createDataFrame([(k, x) for k, x in enumerate(lines)], "k int, t string").select("k", V.parsed("t").alias("r"))
    assert [r.k for r in df.filter("r IS NOT NULL").orderBy("k").collect()] == [0, 1, 2]
    out = V.fields(df, "r", {"id": "bigint", "a.b": "string", "": "int", "q'\"": "boolean", "n": "string"}).orderBy("k").collect()
    assert tuple(out[0])[2:] == (1, "x", 5, True, '{"k":[1,2.5]}', [])
    assert out[1][2] is None and out[1][-1] == ["id"]  # the exact spelling comes first, and isn't a number
    assert out[2][2] == 3 and out[2][3] == "7"
    assert out[3][2] is None and out[3][-1] == []
    exact = V.fields(df, "r", {"ID": "string"}, any_case=False, unfit=None).orderBy("k").collect()
    assert [r.ID for r in exact[:3]] == [None, "2", None] and exact[0].asDict().keys() == {"k", "r", "ID"}
    assert "a.b" in V.schema_of(df, "r") and V.schema_of(df, "r").startswith("OBJECT<")


def test_json_kept_whole(spark, workdir):
    spec = SourceSpec("c", "json", f"{workdir}/land", {"singleVariantColumn": "record"})
    put(f"{workdir}/land", "a_2026-01.json", '{"v": 1}\n\nnot json\n[2]\n')
    args = (f"{workdir}/b", f"{workdir}/c", f"{workdir}/s")
    ingest(spark, spec, *args)
    put(f"{workdir}/land", "b_2026-02.json", '{"v": 2.5, "new": "x"}\n{"v": "z"}\n')
    ingest(spark, spec, *args)
    b = read_bronze(spark, args[0], args[2])
    assert sorted(r._corrupt_record for r in b.filter("record IS NULL").collect()) == ["[2]", "not json"]
    got = V.fields(b.filter("record IS NOT NULL"), "record", {"v": "double", "new": "string"}).collect()
    assert sorted((r.v is None, r.v, r.new, tuple(r._unfit), r.batch_key) for r in got) == [
        (False, 1.0, None, (), "2026-01"), (False, 2.5, "x", (), "2026-02"), (True, None, None, ("v",), "2026-02")]


def test_compare_schema_and_read_as_declared(spark):
    df = spark.createDataFrame([(1, "7", "x", 2.5), (2, "no", None, None)], "ID int, amount string, extra string, `a.b` float")
    declared = T.StructType([T.StructField(n, t) for n, t in (("id", T.LongType()), ("amount", T.DoubleType()), ("a.b", T.FloatType()), ("day", T.DateType()))])
    assert S.compare_schema(df.schema, declared) == [("id", "widened", "int", "bigint"), ("amount", "conflict", "string", "double"),
                                                     ("a.b", "same", "float", "float"), ("day", "added", None, "date"), ("extra", "extra", "string", None)]
    back = S.as_declared(df, declared)
    assert back.schema.simpleString() == "struct<id:bigint,amount:double,a.b:float,day:date>"
    assert sorted(map(tuple, back.collect())) == [(1, 7.0, 2.5, None), (2, None, None, None)]
    assert S.compare_schema(T.StructType([]), declared)[0] == ("id", "added", None, "bigint")


def test_counts_come_out_of_the_write(spark, workdir):
    df = spark.createDataFrame([(1, None, dt.date(2026, 1, 1)), (2, None, None), (None, "x", None)], "k long, `a b` string, d date")
    assert checks.write_observed(df, f"{workdir}/t") == {"rows": 3, "nulls_k": 1, "nulls_a b": 2, "nulls_d": 2}
    assert spark.read.parquet(f"{workdir}/t").count() == 3
    assert checks.write_observed(df.limit(0), f"{workdir}/e") == {"rows": 0, "nulls_k": 0, "nulls_a b": 0, "nulls_d": 0}
