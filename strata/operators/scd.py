"""Slowly changing dimensions, type 1 and type 2.

Two ways to build the same tables:

* **set-based** (``scd1``, ``scd2``): a pure function of all staged batches.
  Rerunning it gives the same rows, a late batch lands in order, and nothing is
  read while it is being overwritten. One shuffle by key; windows run per key
  over at most one row per (key, batch), so a hot key costs #batches rows.
* **per batch** (``scd2_apply``, ``Scd2State``): what each batch opened and
  closed is kept as immutable files per batch below a shared folder; all
  pending batches are applied in one job over the staged rows and the current
  rows of their keys (see ``Scd2State``).

Versions are half-open ``[valid_from, valid_to)``; the open end is NULL and
``is_current`` marks each key's last version. Changes are detected null-safely on a
struct of the tracked columns, so a change to or from NULL is a change.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import changed, tracked_struct
from strata.session import delete_path, has_data, names_below, path_exists

BATCH = "batch_key"
#: Partition of a base by the key's hash, and how many there are.
BUCKET, BASE_BUCKETS = "_bucket", 64


def _version_order(effective_col: str, batch_col: str):
    return [F.col(batch_col), F.col(effective_col)]


def scd1(staged: DataFrame, keys: Sequence[str], cols: Sequence[str], effective_col: str,
         batch_col: str = BATCH, update_col: str = "update_date") -> DataFrame:
    """Type 1: the last row seen per key, in (batch, effective) order.

    Like a merge that updates every matched row, ``update_date`` moves to the
    latest batch even when nothing else changed.
    """
    best = staged.groupBy(*keys).agg(F.max(F.struct(
        F.col(batch_col).alias("_b"), F.col(effective_col).alias("_e"),
        *[F.col(c) for c in cols])).alias("_last"))
    return best.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in cols],
                       F.col("_last._e").alias(update_col))


def _flag_changes(staged: DataFrame, keys: Sequence[str], tracked: Sequence[str],
                  effective_col: str, batch_col: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*_version_order(effective_col, batch_col))
    cur = tracked_struct(tracked)
    return (staged
            .withColumn("_rn", F.row_number().over(w))
            .withColumn("_prev", F.lag(cur).over(w))
            .withColumn("_status", F.when(F.col("_rn") == 1, F.lit("inserted"))
                        .when(changed(cur, F.col("_prev")), F.lit("updated"))
                        .otherwise(F.lit("unchanged"))))


def scd2(staged: DataFrame, keys: Sequence[str], tracked: Sequence[str], effective_col: str,
         batch_col: str = BATCH, carry: Sequence[str] = (), with_batches: bool = False) -> DataFrame:
    """Type 2 history from staged rows (one row per key and batch).

    Returns ``keys + tracked + carry + valid_from, valid_to, is_current``;
    ``with_batches`` adds ``opened_in`` / ``closed_in`` batch keys.
    """
    flagged = _flag_changes(staged, keys, tracked, effective_col, batch_col)
    versions = flagged.filter(F.col("_status") != "unchanged")
    w = Window.partitionBy(*keys).orderBy(*_version_order(effective_col, batch_col))
    out = (versions
           .withColumn("valid_from", F.col(effective_col))
           .withColumn("valid_to", F.lead(F.col(effective_col)).over(w))
           .withColumn("closed_in", F.lead(F.col(batch_col)).over(w))
           # a version is closed by the next one, whatever dates they carry
           .withColumn("is_current", F.lead(F.lit(True)).over(w).isNull()))
    cols = [*keys, *tracked, *carry, "valid_from", "valid_to", "is_current"]
    if with_batches:
        cols += [F.col(batch_col).alias("opened_in"), "closed_in"]
    return out.select(*cols)


def as_of_batch(staged: DataFrame, batch: str, keys: Sequence[str], tracked: Sequence[str],
                effective_col: str, batch_col: str = BATCH, **kw) -> DataFrame:
    """The type 2 table as it stood right after ``batch`` was applied.
    Partition pruning applies when ``batch_col`` is a partition column."""
    return scd2(staged.filter(F.col(batch_col) <= F.lit(batch)), keys, tracked, effective_col, batch_col, **kw)


def batch_change_log(staged: DataFrame, keys: Sequence[str], tracked: Sequence[str],
                     effective_col: str, batch_col: str = BATCH) -> DataFrame:
    """Per batch: keys inserted (new), updated (a version closed and a new one
    opened) and unchanged. Keys absent from a batch are not counted."""
    flagged = _flag_changes(staged, keys, tracked, effective_col, batch_col)
    return (flagged.groupBy(F.col(batch_col).alias("batch_key"))
            .agg(F.count(F.when(F.col("_status") == "inserted", 1)).alias("inserted"),
                 F.count(F.when(F.col("_status") == "updated", 1)).alias("updated"),
                 F.count(F.when(F.col("_status") == "unchanged", 1)).alias("unchanged")))


# ----------------------------------------------------------------------------
# Per-batch path
# ----------------------------------------------------------------------------

def scd2_apply(open_prev: DataFrame, staged_batch: DataFrame, keys: Sequence[str],
               tracked: Sequence[str], effective_col: str, carry: Sequence[str] = ()) -> DataFrame:
    """Apply one staged batch to the current rows.

    Returns every row this batch produces, tagged by ``kind``: ``closed`` (a
    version this batch ended) or ``open`` (all current rows after the batch),
    and ``_new`` (a version opened by this batch). One write yields both kinds,
    so the close and the insert can never disagree, and no key is ever without
    a current row.

    Plan: the current rows are the large side and the batch the small one, so
    the current rows are only ever scanned, never shuffled, whenever the batch
    fits the broadcast limit (Spark's own size check decides):
    current LEFT JOIN batch gives kept, closed and re-opened rows; the keys
    new to the dimension are the batch keys minus those found among the
    current rows (a key-only semi join, then an anti join of two small sides).
    """
    value_cols = [*tracked, *carry]
    s = staged_batch.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in value_cols],
                            F.col(effective_col).alias("_s_eff"), F.lit(True).alias("_in_s"))
    o = open_prev.select(*keys, *[F.col(c).alias(f"_o_{c}") for c in value_cols],
                         F.col("valid_from").alias("_o_from"))
    j = o.join(s, list(keys), "left")
    in_s = F.coalesce(F.col("_in_s"), F.lit(False))
    chg = in_s & changed(F.struct(*[F.col(f"_s_{c}") for c in tracked]),
                         F.struct(*[F.col(f"_o_{c}") for c in tracked]))

    def row(prefix: str, valid_from: str, valid_to, current: bool, kind: str, new: bool):
        return F.struct(*[F.col(k) for k in keys], *[F.col(f"{prefix}{c}").alias(c) for c in value_cols],
                        F.col(valid_from).alias("valid_from"), valid_to.alias("valid_to"),
                        F.lit(current).alias("is_current"), F.lit(kind).alias("kind"), F.lit(new).alias("_new"))

    open_to = F.lit(None).cast("date")
    # each current row yields itself, or (if its key changed) a closed copy and the new version
    out_rows = F.when(chg, F.array(row("_o_", "_o_from", F.col("_s_eff"), False, "closed", False),
                                   row("_s_", "_s_eff", open_to, True, "open", True))) \
        .otherwise(F.array(row("_o_", "_o_from", open_to, True, "open", False)))
    from_current = j.select(F.explode(out_rows).alias("r")).select("r.*")

    found = o.select(*keys).join(s.select(*keys), list(keys), "left_semi")
    fresh = s.join(found, list(keys), "left_anti")
    new_keys = fresh.select(row("_s_", "_s_eff", open_to, True, "open", True).alias("r")).select("r.*")
    return from_current.unionByName(new_keys)


class _State:
    """Immutable per-batch state without a table format.

    ``<root>/batch_key=<b>`` holds what batch ``b`` changed, ``<root>_base/``
    what all batches up to some ``b`` add up to (``consolidate``), and
    ``<root>_commits`` / ``<root>_base_commits`` one record for each of them.
    A record is written after the data and removed before them; data without a
    record (a broken run) is never read, and cleared when the batch is applied
    again. Applying a batch drops it and every later one first, bases included,
    so a late batch cannot meet state that does not know it.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], effective_col: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.keys, self.effective_col = list(keys), effective_col

    def _names(self, path: str) -> list[str]:
        return [n.partition("=")[2] for n in names_below(self.spark, path) if n.startswith(f"{BATCH}=")]

    def applied(self) -> list[str]:
        """Batches with a commit record, in order."""
        return self._names(f"{self.root}_commits")

    def bases(self) -> list[str]:
        return self._names(f"{self.root}_base_commits")

    def drop_from(self, batch: str) -> None:
        """Forgets ``batch`` and everything later."""
        for top in (f"{self.root}_base_commits", f"{self.root}_base", f"{self.root}_base_prints", f"{self.root}_commits", self.root):
            for b in self._names(top):
                if b >= batch:
                    delete_path(self.spark, f"{top}/{BATCH}={b}")

    def _commit(self, rows: Sequence[tuple], schema: str, what: str = "_commits") -> None:
        """Records of batches whose data are written; one row and file each."""
        (self.spark.createDataFrame(rows, f"{BATCH} string, {schema}").coalesce(1)
         .withColumn("applied_at", F.current_timestamp())
         .write.mode("append").partitionBy(BATCH).parquet(f"{self.root}{what}"))

    def log(self) -> DataFrame:
        """What each applied batch did, oldest first (its commit records)."""
        d = self.spark.read.parquet(f"{self.root}_commits")
        return d.withColumn(BATCH, F.col(BATCH).cast("string")).orderBy(BATCH)

    def _base_before(self, batch: str) -> str | None:
        found = [b for b in self.bases() if b <= batch]
        return found[-1] if found else None

    def _changes(self, schema, batch: str, after: str | None) -> DataFrame:
        """Rows of the committed batches in (after, batch]; older partitions are pruned."""
        wanted = [b for b in self.applied() if b <= batch and (after is None or b > after)]
        if not wanted or not has_data(self.spark, self.root):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.root).filter(F.col(BATCH).isin(wanted))

    def fold(self, every: int | None) -> None:
        """Consolidates when ``every`` or more batches lie after the newest base."""
        done, bases = self.applied(), self.bases()
        if every and len([b for b in done if not bases or b > bases[-1]]) >= every:
            self.consolidate(done[-1])


def image_type(schema: T.StructType, tracked: Sequence[str]) -> T.StructType:
    """A version's start and tracked values."""
    return T.StructType([schema["valid_from"], *[schema[c] for c in tracked]])


class Scd2State(_State):
    """Per-batch state of one type 2 dimension, as deltas.

    ``kind=opened`` holds the versions a batch opened, ``kind=closed`` those it
    ended; a batch that changes nothing writes no rows. The history after ``b``
    is every closed version with batch <= b plus the opened ones not closed by
    then. All pending batches are applied in one job: the staged rows and the
    current rows of *their* keys go through the set-based ``scd2``; untouched
    keys are neither shuffled nor written. A base has a file of keys and
    fingerprints beside it: rows that say what is current already are found by
    it and go no further, and wide rows are read for the other keys' buckets only.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], tracked: Sequence[str],
                 effective_col: str, carry: Sequence[str] = (), log: bool = False):
        super().__init__(spark, root, keys, effective_col)
        self.tracked, self.carry = list(tracked), list(carry)

    def _schema(self, staged: DataFrame) -> T.StructType:
        types = {f.name: f.dataType for f in staged.schema}
        day = types[self.effective_col]
        cols = [(c, types[c]) for c in (*self.keys, *self.tracked, *self.carry)]
        cols += [("valid_from", day), ("valid_to", day), ("is_current", T.BooleanType()), ("opened_in", T.StringType()),
                 (BATCH, T.StringType()), ("kind", T.StringType())]
        return T.StructType([T.StructField(n, t) for n, t in cols])

    def _stored_schema(self) -> T.StructType:
        """Kept next to the data, so that reads need no inference."""
        return T.StructType.fromJson(json.loads(self.spark.read.text(f"{self.root}_schema").first()[0]))

    def _parts(self, batch: str) -> tuple[DataFrame, DataFrame]:
        """(closed, current) versions after ``batch``."""
        schema, base = self._stored_schema(), self._base_before(batch)
        d = self._changes(schema, batch, base)
        closed, opened = d.filter("kind = 'closed'"), d.filter("kind = 'opened'")
        if base is not None:
            b = self._base(base)
            closed, opened = b.filter("kind = 'closed'").union(closed), b.filter("kind = 'opened'").union(opened)
        ended = d.filter("kind = 'closed'").select(*self.keys, "opened_in")
        return closed, opened.join(ended, [*self.keys, "opened_in"], "left_anti").select(*schema.names)

    def _base(self, base: str, buckets: Sequence[int] | None = None) -> DataFrame:
        """Rows of a base, of some buckets of the key only if told."""
        schema = self._stored_schema()
        wide = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])
        rows = self.spark.read.schema(wide).parquet(f"{self.root}_base").filter(F.col(BATCH) == base)
        return (rows if buckets is None else rows.filter(F.col(BUCKET).isin(list(buckets)))).select(*schema.names)

    def _bucket(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(BASE_BUCKETS)).cast("int")

    def _prints(self) -> list:
        """128 bits of the tracked columns and carried ones; NULL is a value of its own."""
        values = [v for c in (*self.tracked, *self.carry) for v in (F.col(c).isNull(), F.col(c))]
        return [F.xxhash64(*values).alias("_p1"), F.xxhash64(F.lit("second"), *values).alias("_p2")]

    def unchanged_keys(self, rows: DataFrame, previous: str) -> DataFrame | None:
        """Keys whose rows all have the values that are current after ``previous``,
        by their fingerprints; None if there is no base to compare with. Of the
        state only the base's (key, fingerprint) file is read, and the keys of the
        batches after it."""
        base = self._base_before(previous)
        if base is None or not path_exists(self.spark, f"{self.root}_base_prints/{BATCH}={base}"):
            return None
        types = [self._stored_schema()[k] for k in self.keys]
        narrow = T.StructType([*types, T.StructField("_p1", T.LongType()), T.StructField("_p2", T.LongType())])
        prints = self.spark.read.schema(narrow).parquet(f"{self.root}_base_prints/{BATCH}={base}")
        own = rows.select(*self.keys, *self._prints()).groupBy(*self.keys).agg(
            F.min(F.struct("_p1", "_p2")).alias("_least"), F.max(F.struct("_p1", "_p2")).alias("_most"))
        same = prints.withColumn("_print", F.struct("_p1", "_p2")).select(*self.keys, "_print").join(own, self.keys)
        same = same.filter((F.col("_least") == F.col("_print")) & (F.col("_most") == F.col("_print"))).select(*self.keys)
        since = self._changes(self._stored_schema(), previous, base).select(*self.keys).distinct()
        return same.join(since, self.keys, "left_anti")

    def open_at(self, batch: str) -> DataFrame:
        """Current versions after ``batch``, with the batch that opened them."""
        return self._parts(batch)[1].drop(BATCH, "kind")

    def history_at(self, batch: str) -> DataFrame:
        """The type 2 table as it stood after ``batch``."""
        closed, current = self._parts(batch)
        return closed.union(current).drop(BATCH, "kind", "opened_in")

    def changes_between(self, after: str | None, upto: str) -> DataFrame:
        """What the batches in (after, upto] did to each key, net: one row per key
        with ``change`` (insert, update or delete) and the images before and
        after (``old_<c>`` / ``new_<c>`` of the tracked columns, their ``valid_from``).

        A key whose last version has the tracked values of its first again (A, B, A) has
        no row. Only those batches' partitions are read: a version that was
        current at ``after`` and isn't any more was closed in one of them, with
        its values, and one that is new was opened in one.
        """
        schema = self._stored_schema()
        d = self._changes(schema, upto, after)
        image = F.struct("valid_from", *self.tracked)
        opened_before = F.lit(False) if after is None else F.col("opened_in") <= after
        ended = d.filter("kind = 'closed'").select(*self.keys, "opened_in", F.lit(True).alias("_ended"))
        # one version per key and batch: an opened one stands unless it was closed since
        opened = d.filter("kind = 'opened'").join(ended, [*self.keys, "opened_in"], "left").filter("_ended IS NULL")
        old = d.filter("kind = 'closed'").filter(opened_before).select(*self.keys, image.alias("_old"), F.lit(None).cast(image_type(schema, self.tracked)).alias("_new"))
        new = opened.select(*self.keys, F.lit(None).cast(image_type(schema, self.tracked)).alias("_old"), image.alias("_new"))
        net = old.unionByName(new).groupBy(*self.keys).agg(F.max("_old").alias("_old"), F.max("_new").alias("_new"))
        same = F.struct(*[F.col(f"_old.{c}") for c in self.tracked]).eqNullSafe(F.struct(*[F.col(f"_new.{c}") for c in self.tracked]))
        change = F.when(F.col("_old").isNull(), "insert").when(F.col("_new").isNull(), "delete").when(~same, "update")
        return net.withColumn("change", change).filter("change IS NOT NULL").select(
            *self.keys, "change", *[F.col(f"_old.{c}").alias(f"old_{c}") for c in self.tracked],
            *[F.col(f"_new.{c}").alias(f"new_{c}") for c in self.tracked],
            F.col("_old.valid_from").alias("old_valid_from"), F.col("_new.valid_from").alias("new_valid_from"))

    def consolidate(self, batch: str) -> None:
        """Folds everything up to ``batch`` into one base, so that reads stop
        listing one small directory per old batch. Batch directories stay
        (older reads use them); the base is dropped when a late batch comes."""
        delete_path(self.spark, f"{self.root}_base_commits/{BATCH}={batch}")
        delete_path(self.spark, f"{self.root}_base/{BATCH}={batch}")
        delete_path(self.spark, f"{self.root}_base_prints/{BATCH}={batch}")
        closed, current = self._parts(batch)
        rows = closed.union(current).withColumn(BATCH, F.lit(batch)).withColumn(BUCKET, self._bucket())
        # file count from the data: AQE cuts the rebalanced rows to the advisory size
        rows.hint("rebalance", "kind", BUCKET).write.mode("append").partitionBy(BATCH, "kind", BUCKET).parquet(f"{self.root}_base")
        prints = self._base(batch).filter("kind = 'opened'").select(*self.keys, *self._prints())
        prints.hint("rebalance").sortWithinPartitions(*self.keys).write.parquet(f"{self.root}_base_prints/{BATCH}={batch}")
        self._commit([(batch, 1)], "folded int", "_base_commits")

    def apply_all(self, staged: DataFrame, batches: Sequence[str], previous: str | None) -> dict[str, dict]:
        """Applies ``batches`` (in order, all of ``staged``'s) after ``previous``;
        returns ``{closed, opened, current}`` per batch."""
        self.drop_from(batches[0])
        schema = self._schema(staged)
        if not path_exists(self.spark, f"{self.root}_schema"):
            self.spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.text(f"{self.root}_schema")
        cols = [*self.keys, *self.tracked, *self.carry]
        rows = staged.select(*cols, self.effective_col, F.col(BATCH).cast("string").alias(BATCH))
        if previous is not None:
            same = self.unchanged_keys(rows, previous)
            if same is not None:
                rows = rows.join(same, self.keys, "left_anti").select(*rows.columns)
            touched = rows.select(*self.keys).distinct()
            before = self._open_of(touched, previous, same is not None)
            rows = rows.union(before.select(*cols, F.col("valid_from").alias(self.effective_col), F.col("opened_in").alias(BATCH)))
        versions = scd2(rows, self.keys, self.tracked, self.effective_col, carry=self.carry, with_batches=True)

        def event(kind: str, batch, valid_to, current: bool):
            return F.struct(*cols, "valid_from", valid_to.alias("valid_to"), F.lit(current).alias("is_current"), "opened_in",
                            batch.alias(BATCH), F.lit(kind).alias("kind"))

        opened = F.when(F.col("opened_in") >= batches[0],
                        event("opened", F.col("opened_in"), F.lit(None).cast(schema["valid_to"].dataType), True))
        closed = F.when(F.col("closed_in").isNotNull(), event("closed", F.col("closed_in"), F.col("valid_to"), False))
        events = versions.select(F.explode(F.filter(F.array(opened, closed), lambda e: e.isNotNull())).alias("e")).select("e.*")
        events.hint("rebalance", BATCH).write.mode("append").partitionBy(BATCH, "kind").parquet(self.root)
        # the partitions just written, counted from their footers
        number = {b: {"closed": 0, "opened": 0} for b in batches}
        if has_data(self.spark, self.root):
            written = self.spark.read.schema(schema).parquet(self.root).filter(F.col(BATCH) >= batches[0])
            for r in written.groupBy(BATCH, "kind").count().collect():
                number[r[BATCH]][r["kind"]] = r["count"]
        current = self._current(previous)
        for b in batches:
            current += number[b]["opened"] - number[b]["closed"]
            number[b]["current"] = current
        self._commit([(b, n["closed"], n["opened"], n["current"]) for b, n in number.items()],
                     "closed long, opened long, current long")
        return number

    def _open_of(self, touched: DataFrame, previous: str, few: bool) -> DataFrame:
        """Current versions after ``previous`` of some keys; if they are ``few``, wide
        rows of the base are read from their buckets only."""
        base = self._base_before(previous)
        if not few or base is None:
            return self.open_at(previous).join(touched, self.keys, "left_semi")
        schema = self._stored_schema()
        buckets = [r[0] for r in touched.select(self._bucket().alias("b")).distinct().collect()]  # at most BASE_BUCKETS
        d = self._changes(schema, previous, base)
        opened = d.filter("kind = 'opened'")
        if buckets:
            opened = self._base(base, buckets).filter("kind = 'opened'").union(opened)
        ended = d.filter("kind = 'closed'").select(*self.keys, "opened_in")
        current = opened.join(ended, [*self.keys, "opened_in"], "left_anti").select(*schema.names).drop(BATCH, "kind")
        return current.join(touched, self.keys, "left_semi")

    def _current(self, batch: str | None) -> int:
        if batch is None:
            return 0
        return self.spark.read.parquet(f"{self.root}_commits/{BATCH}={batch}").first()["current"]

    def apply(self, batch: str, staged_batch: DataFrame, previous: str | None) -> dict:
        """Applies one batch; returns ``{closed, opened, current}`` row counts.
        A batch without changes opens and closes nothing and writes no rows."""
        return self.apply_all(staged_batch.withColumn(BATCH, F.lit(batch)), [batch], previous)[batch]


class Scd1State(_State):
    """Per-batch state of a type 1 dimension: ``batch_key=<b>/`` holds the rows
    batch ``b`` brought; the table after ``b`` is the last row of each key
    among the newest base and the batches after it (every matched key is
    updated, like a merge)."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], cols: Sequence[str],
                 effective_col: str, update_col: str = "update_date", log: bool = False):
        super().__init__(spark, root, keys, effective_col)
        self.cols, self.update_col = list(cols), update_col

    def _stored_schema(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.spark.read.text(f"{self.root}_schema").first()[0]))

    def _rows(self, batch: str) -> DataFrame:
        schema, base = self._stored_schema(), self._base_before(batch)
        rows = self._changes(schema, batch, base)
        if base is not None:
            rows = self.spark.read.schema(schema).parquet(f"{self.root}_base").filter(F.col(BATCH) == base).union(rows)
        return rows

    def snapshot_at(self, batch: str) -> DataFrame:
        return scd1(self._rows(batch), self.keys, self.cols, self.effective_col, update_col=self.update_col)

    def consolidate(self, batch: str) -> None:
        """Folds all rows up to ``batch`` into one base of a row per key."""
        delete_path(self.spark, f"{self.root}_base_commits/{BATCH}={batch}")
        delete_path(self.spark, f"{self.root}_base/{BATCH}={batch}")
        rows = self.snapshot_at(batch).withColumnRenamed(self.update_col, self.effective_col).withColumn(BATCH, F.lit(batch))
        rows.select(*self._stored_schema().names).hint("rebalance").write.mode("append").partitionBy(BATCH) \
            .parquet(f"{self.root}_base")
        self._commit([(batch, 1)], "folded int", "_base_commits")

    def apply_all(self, staged: DataFrame, batches: Sequence[str], previous: str | None) -> dict[str, dict]:
        self.drop_from(batches[0])
        rows = staged.select(*self.keys, *self.cols, self.effective_col, F.col(BATCH).cast("string").alias(BATCH))
        if not path_exists(self.spark, f"{self.root}_schema"):
            self.spark.createDataFrame([(rows.schema.json(),)], "value string").coalesce(1).write.text(f"{self.root}_schema")
        rows.hint("rebalance", BATCH).write.mode("append").partitionBy(BATCH).parquet(self.root)
        number = dict.fromkeys(batches, 0)
        if has_data(self.spark, self.root):
            written = self.spark.read.schema(self._stored_schema()).parquet(self.root).filter(F.col(BATCH) >= batches[0])
            number |= {r[BATCH]: r["count"] for r in written.groupBy(BATCH).count().collect()}
        self._commit(list(number.items()), "rows long")
        return {b: {"rows": n} for b, n in number.items()}

    def apply(self, batch: str, staged_batch: DataFrame, previous: str | None) -> dict:
        return self.apply_all(staged_batch.withColumn(BATCH, F.lit(batch)), [batch], previous)[batch]


def applied_batches(state: _State) -> list[str]:
    """Batches whose state is committed."""
    return state.applied()


def catch_up(spark: SparkSession, staged: DataFrame, state: _State, batch_col: str = BATCH,
             force_from: str | None = None, fold_every: int | None = None) -> list[str]:
    """Apply every staged batch that is not applied yet, all in one job. A late
    batch (one that sorts before batches already applied) is applied and every
    later batch is re-applied after it, so the result equals processing in
    order. ``force_from`` re-applies from that batch on even if it was applied
    (its input changed); ``fold_every`` consolidates the state after so many
    batches. Returns the batches (re)applied."""
    done = set(state.applied())
    staged = staged.withColumn(batch_col, F.col(batch_col).cast("string"))
    staged_keys = sorted(r[0] for r in staged.select(batch_col).distinct().collect())
    starts = [b for b in staged_keys if b not in done]
    if force_from is not None:
        starts.append(force_from)
    if not starts:
        return []
    start = min(starts)
    todo = [b for b in staged_keys if b >= start]
    before = [b for b in staged_keys if b < start]
    state.drop_from(start)
    if todo:
        rows = staged.filter(F.col(batch_col) >= start).withColumnRenamed(batch_col, BATCH)
        state.apply_all(rows, todo, before[-1] if before else None)
        state.fold(fold_every)
    return todo


def replay(spark: SparkSession, staged: DataFrame, batches: Sequence[str], state: Scd2State,
           batch_col: str = BATCH) -> DataFrame:
    """Apply ``batches`` from nothing, in one job, and return the final history;
    the state can then be read as of each of them."""
    rows = staged.filter(F.col(batch_col).isin(list(batches))).withColumnRenamed(batch_col, BATCH)
    state.drop_from(batches[0])
    state.apply_all(rows, list(batches), None)
    return state.history_at(batches[-1])
