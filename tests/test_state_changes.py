"""Buckets rewritten alone, net changes, a stream into state, co-located tables."""

import datetime as dt
import os

import pytest
from pyspark.errors import StreamingQueryException

from strata.operators import layout, merge, scd
from strata.operators import publish as P
from strata.operators.clean import dedup_latest
from strata.session import delete_path, move_path, write_text
from strata.streaming.sink import StateSink
from test_plans import plan

SET = {"v": "source.v", "n": "target.n + source.n"}
INSERT = {"k": "source.k", "v": "source.v", "n": "source.n"}


def rows_of(spark, *rows):
    return spark.createDataFrame(list(rows), "k long, v string, n long")


def files(path):
    path = path.removeprefix("file:")
    return {f"{d}/{n}": os.stat(f"{d}/{n}").st_mtime_ns for d, _, names in os.walk(path) for n in names if n.endswith(".parquet")}


def test_upsert_rewrites_touched_buckets_only(spark, workdir):
    t = merge.BucketedTable(spark, f"{workdir}/t", ["k"], buckets=16)
    t.create(spark.range(200).selectExpr("id AS k", "'a' AS v", "1L AS n"))
    before = files(f"{workdir}/t")
    assert t.upsert(rows_of(spark, (7, "b", 5), (1000, "new", 1), (None, "null key", 1)), SET, INSERT)
    after = files(f"{workdir}/t")
    same = {p for p in before if after.get(p) == before[p]}
    assert len(same) >= 13 and len({os.path.dirname(p) for p in before}) == 16
    got = {r.k: (r.v, r.n) for r in t.rows().collect()}
    assert len(got) == 202 and got[7] == ("b", 6) and got[1000] == ("new", 1) and got[8] == ("a", 1) and got[None] == ("null key", 1)
    assert t.delete(spark.createDataFrame([(7,), (5000,)], "k long"))
    assert {r.k for r in t.rows().collect()} == {*range(200), 1000, None} - {7}
    assert t.upsert(rows_of(spark), SET, INSERT, epoch=3) and t.applied() == 3
    with pytest.raises(ValueError, match="buckets"):
        merge.BucketedTable(spark, f"{workdir}/t", ["k"], buckets=8).upsert(rows_of(spark, (1, "x", 1)), SET, INSERT)


class Stop(Exception):
    pass


@pytest.mark.parametrize("after", [0, 1, 2, 3, 5, 7, 8, 9, 10])
def test_an_epoch_is_merged_once(spark, workdir, monkeypatch, after):
    """Counters show it: the epoch is stopped somewhere, then sent again, twice."""
    t, left = merge.BucketedTable(spark, f"{workdir}/t", ["k"], buckets=4), [10**9]
    t.create(rows_of(spark, (1, "a", 1), (2, "a", 1), (3, "a", 1)), epoch=0)

    def limited(operation):
        def run(*args):
            left[0] -= 1
            if left[0] < 0:
                raise Stop
            return operation(*args)
        return run

    for f in (delete_path, move_path, write_text):
        monkeypatch.setattr(P, f.__name__, limited(f))
    source = rows_of(spark, (1, "b", 10), (4, "b", 10))
    left[0] = after
    try:
        t.upsert(source, SET, INSERT, epoch=1)
    except Stop:
        pass
    left[0] = 10**9
    again = merge.BucketedTable(spark, f"{workdir}/t", ["k"], buckets=4)
    again.upsert(source, SET, INSERT, epoch=1)
    assert not again.upsert(source, SET, INSERT, epoch=1)
    assert {r.k: r.n for r in again.rows().collect()} == {1: 11, 2: 1, 3: 1, 4: 10}


def day(n):
    return dt.date(2026, 1, n)


def state_of(spark, workdir, rows):
    staged = spark.createDataFrame([(k, v, day(b), f"2026-01-{b:02d}") for k, v, b in rows], "k long, v string, d date, batch_key string")
    state = scd.Scd2State(spark, f"{workdir}/state", ["k"], ["v"], "d")
    scd.replay(spark, staged, sorted({f"2026-01-{b:02d}" for _, _, b in rows}), state)
    return state


def test_net_changes_fold_what_lies_between(spark, workdir):
    state = state_of(spark, workdir, [
        (1, "A", 1), (1, "B", 2), (1, "A", 3),  # back where it was
        (2, "A", 1), (2, "B", 2), (2, "C", 3),  # twice
        (3, "N", 2), (3, "M", 3),               # new, then changed
        (4, "A", 1), (4, "A", 2),               # unchanged
        (5, None, 1), (5, "x", 3),              # from null
        (6, "A", 1), (6, "B", 4)])              # later only

    def net(a, b):
        return sorted(tuple(r) for r in state.changes_between(a, b).collect())

    assert net("2026-01-01", "2026-01-03") == [
        (2, "update", "A", "C", day(1), day(3)), (3, "insert", None, "M", None, day(3)), (5, "update", None, "x", day(1), day(3))]
    assert net("2026-01-03", "2026-01-04") == [(6, "update", "A", "B", day(1), day(4))]
    assert net(None, "2026-01-01") == [(1, "insert", None, "A", None, day(1)), (2, "insert", None, "A", None, day(1)),
                                       (4, "insert", None, "A", None, day(1)), (5, "insert", None, None, None, day(1)), (6, "insert", None, "A", None, day(1))]
    assert net("2026-01-02", "2026-01-02") == []
    before = net("2026-01-01", "2026-01-03")
    state.consolidate("2026-01-03")
    assert net("2026-01-01", "2026-01-03") == before
    text = plan(state.changes_between("2026-01-01", "2026-01-03"))
    assert "batch_key#" in text.split("PartitionFilters: [")[1].split("]")[0] and "2026-01-04" not in text


@pytest.mark.parametrize("stopped", [0, 1, 2])
def test_a_stream_fills_state_once(spark, workdir, stopped):
    """Days come in parts and late; one epoch is stopped before its record."""
    drops = [[(1, "a", 1, 1), (2, "a", 1, 2)], [(1, "b", 3, 3), (3, "c", 3, 4), (1, "late", 2, 5)], [(2, "z", 1, 9), (3, "d", 4, 6), (1, "b", 4, 7)]]
    schema = "k long, v string, d int, seq long"

    def typed(df):
        return df.selectExpr("k", "v", "make_date(2026, 1, d) AS d", "seq", "concat('2026-01-0', d) AS batch_key")

    def stage(rows):
        return dedup_latest(rows, ["k", "batch_key"], ["seq"])

    def stop(epoch):
        raise Stop(epoch)

    state = scd.Scd2State(spark, f"{workdir}/state", ["k"], ["v"], "d")
    for n, rows in enumerate(drops):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{workdir}/land")
        stream = typed(spark.readStream.schema(schema).parquet(f"{workdir}/land"))
        if n == stopped:
            with pytest.raises(StreamingQueryException):
                StateSink(spark, f"{workdir}/sink", state, stage, on_apply=stop).drain(stream, f"{workdir}/cp")
        sink = StateSink(spark, f"{workdir}/sink", state, stage, fold_every=2)
        sink.drain(stream, f"{workdir}/cp")
        whole = stage(typed(spark.createDataFrame([r for d in drops[:n + 1] for r in d], schema)))
        want = scd.scd2(whole, ["k"], ["v"], "d")
        got = state.history_at(state.applied()[-1]).select(*want.columns)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
        assert not sink.apply(typed(spark.createDataFrame(drops[0], schema)), n)  # recorded: passed over


def test_tables_bucketed_alike_join_without_a_shuffle(spark, workdir):
    big = spark.range(1000).selectExpr("id % 50 AS k", "id AS v")
    small = spark.range(50).selectExpr("id AS k", "'x' AS w")
    f = layout.write_bucketed(big, "t_fact_bucketed", f"{workdir}/f", ["k"], 4)
    d = layout.write_bucketed(small, "t_dim_bucketed", f"{workdir}/d", ["k"], 4)
    joined = f.hint("merge").join(d, "k")
    text = plan(joined.groupBy("k").count())
    assert "SortMergeJoin" in text and "Exchange" not in text
    assert joined.count() == 1000
    spark.sql("DROP TABLE t_fact_bucketed")
    spark.sql("DROP TABLE t_dim_bucketed")


def test_fingerprints_find_what_is_current_already(spark, workdir):
    """Equal to the set-based history; a batch that repeats reads no wide row."""
    rows = [(k, "a" if k % 3 else None, 1) for k in range(40)] + [(k, "b", 2) for k in range(5)]
    state = state_of(spark, workdir, rows)
    state.consolidate("2026-01-02")
    later = [(k, "a" if k % 3 else None, 3) for k in range(5, 40)] + [(0, "b", 3), (1, "c", 3), (2, None, 3), (99, "new", 3)]
    more = [(1, "c", 4), (2, "b", 4), (3, "b", 4), (3, "b", 5), (4, "x", 4), (4, "b", 5), (99, "new", 5)]

    def staged(of):
        return spark.createDataFrame([(k, v, day(b), f"2026-01-{b:02d}") for k, v, b in of], "k long, v string, d date, batch_key string")

    same = state.unchanged_keys(staged(later), "2026-01-02")
    assert sorted(r.k for r in same.collect()) == [0, *range(5, 40)]
    text = plan(same)
    assert "ReadSchema: struct<k:bigint,_p1:bigint,_p2:bigint>" in text
    assert state.apply_all(staged(later), ["2026-01-03"], "2026-01-02") == {"2026-01-03": {"closed": 2, "opened": 3, "current": 41}}
    # keys that changed after the base are not taken for current by its fingerprints
    assert sorted(r.k for r in state.unchanged_keys(staged([(1, "b", 4), (3, "b", 4), (2, None, 4)]), "2026-01-03").collect()) == [3]
    state.apply_all(staged(more), ["2026-01-04", "2026-01-05"], "2026-01-03")
    want = scd.scd2(staged(rows + later + more), ["k"], ["v"], "d")
    got = state.history_at("2026-01-05").select(*want.columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    state.consolidate("2026-01-05")
    top = f"{workdir}/state_base".removeprefix("file:")
    for d, _, names in os.walk(f"{top}/batch_key=2026-01-05"):
        for n in names:
            if n.endswith(".parquet"):
                os.remove(f"{d}/.{n}.crc")
                with open(f"{d}/{n}", "wb") as f:
                    f.write(b"broken")
    done = state.apply_all(staged([(0, "b", 6), (4, "b", 6), (7, "a", 6)]), ["2026-01-06"], "2026-01-05")
    assert done["2026-01-06"]["opened"] == done["2026-01-06"]["closed"] == 0
