"""Registered queries: one per operator family of the reference, each with
the DuckDB SQL that must give the same rows.

Every query reads whole driver tables (or feeds Spark derives from them by a
fixed rule), so its work grows with the data. Queries that write (ingest,
compaction, partitioned facts, per-batch state) write below a fresh directory
under the session's shared checkpoint folder and return what they read back.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from strata.functions import variants
from strata.functions.columns import batch_key_of, business_date, valid_on
from strata.operators import access, asof, checks, gold, joins, layout, merge, ordered, scd
from strata.operators import clean as C
from strata.operators.publish import Progress, publish
from strata.plans import feeds, flow
from strata.session import delete_path, scratch_dir
from strata.sources import schemas
from strata.sources.landing import land
from strata.sources.tables import table
from strata.streaming import bronze as B
from strata.streaming.sink import StateSink

# Query parameters (dates inside the 30 days that `events` covers).
AS_OF_DATE = "2024-01-15"      # state of every user on this day
AS_OF_BATCH = "2024-01-10"     # dimension as it stood after this batch
CHANGE_BATCH = "2024-01-20"    # batch whose changes are detected / applied
UPSERT_SPLIT = "2024-01-15"    # type 1 state up to here, then upsert the rest
STALE_DAY = "2024-01-15"       # broken copy: is_current frozen on this day
LATE_BATCH = "2024-01-12"      # arrives after all others
FOLDED_BATCH = "2024-01-20"    # the state was folded here before the late batch came
REFRESH_YEAR = 1996            # year of the fact that is refreshed
DROP_YEARS = (1997, 2000)      # first years of the second and third drop
RETENTION_START, RETENTION_END, RETENTION_DAYS = "2024-01-20", "2024-03-01", 20
EMPTIED = (1998, 8)            # month of the fact that loses all its orders
ANALYST = "data_analysts"

ORDER_TYPES = {"order_id": "bigint", "customer_id": "bigint", "amount": "double",
               "order_date": "date:yyyy-MM-dd", "batch_key": "string"}
ORDER_RULES = [C.not_null("order_id"), C.positive("amount")]


# ----------------------------------------------------------------------------
# Shared pieces
# ----------------------------------------------------------------------------

def _clean_orders(spark, sf):
    good, bad = C.clean(feeds.orders_raw(spark, sf), ORDER_TYPES, ORDER_RULES, key=["order_id"],
                        order=["batch_key"], fill={"amount": 0.0}, raw_cols=["order_id", "batch_key"])
    good = good.select("order_id", "customer_id", "amount", "order_date",
                       F.year("order_date").alias("year"), F.month("order_date").alias("month"), "batch_key")
    return good, bad


def _current_customers(spark, sf):
    return feeds.customer_dim(spark, sf).filter("is_current")


def _join_sides(spark, sf):
    """Whole tables with unmatched rows on both sides: prospects have no orders,
    some orders no (known) customer."""
    dim = _current_customers(spark, sf).select("customer_id", "name", "city").unionByName(feeds.prospects(spark, sf))
    return dim, _clean_orders(spark, sf)[0].select("order_id", "customer_id", "amount")


def _double_loaded(spark, sf):
    """A broken copy: history as of AS_OF_DATE's batch appended again to the
    full history without closing anything (what replaying batches on top of
    a finished dimension produces)."""
    staged = feeds.staged_users(spark, sf)
    full = scd.scd2(staged, feeds.USER_KEYS, feeds.USER_TRACKED, feeds.USER_EFFECTIVE)
    early = scd.as_of_batch(staged, STALE_DAY, feeds.USER_KEYS, feeds.USER_TRACKED, feeds.USER_EFFECTIVE)
    return full.unionByName(early)


def _stale_flags(spark, sf):
    """A broken copy: ``is_current`` last refreshed on STALE_DAY."""
    return feeds.user_history(spark, sf).withColumn("is_current", valid_on(STALE_DAY))


# ----------------------------------------------------------------------------
# Queries
# ----------------------------------------------------------------------------

def pit_revenue_by_type(spark: SparkSession, sf: str) -> DataFrame:
    """Revenue by product category at the price valid on each order's date.

    Lines are first summed per (part, order day) — the price is the same for
    all of them — so the point-in-time join sees one row per part and day."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    o = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("order_date"))
    per_day = (li.join(o, li["l_orderkey"] == o["o_orderkey"])
               .groupBy(F.col("l_partkey").alias("product_id"), "order_date")
               .agg(F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("quantity")))
    priced = asof.pit_join(per_day, feeds.part_history(spark, sf), ["product_id"], "order_date",
                           dim_cols=["category", "price"])
    revenue = F.col("quantity").cast("decimal(18,2)") * F.col("price").cast("decimal(12,2)")
    return (priced.groupBy("category")
            .agg(F.sum("lines").alias("lines"), F.sum("quantity").alias("quantity"),
                 F.sum(revenue).cast("double").alias("revenue")))


def scd2_events_history(spark, sf):
    """Type 2 history of each user's daily state, set-based."""
    return feeds.user_history(spark, sf)


def scd2_events_current(spark, sf):
    """Current version of every user (H-1)."""
    return feeds.user_history(spark, sf).filter("is_current")


def scd2_events_replay(spark, sf):
    """The per-batch path over every batch, applied in one job; must equal the
    set-based history."""
    staged, state = _staged_state(spark, sf, "scd2-replay")
    batches = [r[0] for r in staged.select("batch_key").distinct().orderBy("batch_key").collect()]
    return scd.replay(spark, staged, batches, state) \
        .select("user_id", "event_type", "valid_from", "valid_to", "is_current")


def scd1_events_replay(spark, sf):
    """Type 1 by batches (each batch's rows kept apart), over every batch; must
    equal the set-based type 1."""
    staged, _ = _staged_state(spark, sf, "scd1-replay")
    state = scd.Scd1State(spark, scratch_dir(spark, "scd1-state"), feeds.USER_KEYS, feeds.USER_TRACKED, feeds.USER_EFFECTIVE)
    scd.catch_up(spark, staged, state)
    return state.snapshot_at(scd.applied_batches(state)[-1])


def scd2_part_price_history(spark, sf):
    """Type 2 history of the product price list (effective date = batch's business date)."""
    return feeds.part_history(spark, sf)


def scd2_part_price_replay(spark, sf):
    """Per-batch type 2 over the three price-list batches (effective date =
    the batch's business date); must equal the set-based price history."""
    root = scratch_dir(spark, "scd2-part-replay")
    staged = feeds.part_feed(spark, sf)
    state = scd.Scd2State(spark, f"{root}/state", feeds.PART_KEYS, feeds.PART_TRACKED, "business_date")
    scd.catch_up(spark, staged, state)
    return state.history_at(scd.applied_batches(state)[-1]) \
        .select(*feeds.PART_KEYS, *feeds.PART_TRACKED, "valid_from", "valid_to", "is_current")


def scd1_events(spark, sf):
    """Type 1: each user's last state and the date it was last seen."""
    return scd.scd1(feeds.staged_users(spark, sf), feeds.USER_KEYS, feeds.USER_TRACKED, feeds.USER_EFFECTIVE)


def upsert_events(spark, sf):
    """Type 1 state up to UPSERT_SPLIT, then the later batches upserted into it (D-1)."""
    staged = feeds.staged_users(spark, sf)
    target = scd.scd1(staged.filter(F.col("batch_key") <= UPSERT_SPLIT), ["user_id"], ["event_type"], "event_date")
    later = C.dedup_latest(staged.filter(F.col("batch_key") > UPSERT_SPLIT)
                           .select("user_id", "batch_key", "event_date", "event_type"),
                           ["user_id"], ["batch_key", "event_date"])
    return merge.upsert(target, later, ["user_id"],
                        set_cols={"event_type": "source.event_type", "update_date": "source.event_date"},
                        insert_cols={"user_id": "source.user_id", "event_type": "source.event_type",
                                     "update_date": "source.event_date"})


def close_changed(spark, sf):
    """Update-only merge: current versions of users whose state changes in
    CHANGE_BATCH get closed on that day; all other rows stay as they were."""
    staged = feeds.staged_users(spark, sf)
    before = scd.scd2(staged.filter(F.col("batch_key") < CHANGE_BATCH), ["user_id"], ["event_type"], "event_date")
    batch = staged.filter(F.col("batch_key") == CHANGE_BATCH)
    cur = before.filter("is_current").select("user_id", F.col("event_type").alias("cur_type"))
    changes = (batch.join(cur, "user_id", "left")
               .filter(F.col("cur_type").isNull() | ~F.col("event_type").eqNullSafe(F.col("cur_type")))
               .select("user_id", "event_date"))
    return merge.update_matched(before, changes, ["user_id"],
                                set_cols={"valid_to": "source.event_date", "is_current": "false"},
                                target_filter=F.col("target.is_current"))


def state_as_of_date(spark, sf):
    """State of every user on AS_OF_DATE (half-open intervals)."""
    return asof.state_on(feeds.user_history(spark, sf), AS_OF_DATE) \
        .select("user_id", "event_type", "valid_from", "valid_to")


def state_as_of_batch(spark, sf):
    """The type 2 table as it stood right after batch AS_OF_BATCH."""
    return scd.as_of_batch(feeds.staged_users(spark, sf), AS_OF_BATCH, feeds.USER_KEYS, feeds.USER_TRACKED,
                           feeds.USER_EFFECTIVE)


def batch_change_log(spark, sf):
    """Per batch: users inserted, updated and unchanged."""
    return scd.batch_change_log(feeds.staged_users(spark, sf), feeds.USER_KEYS, feeds.USER_TRACKED,
                                feeds.USER_EFFECTIVE)


def discover_batches(spark, sf):
    """Batch keys over every source's file names (events land as one file a
    day in a dated directory, orders one file a month); the key is taken from
    the basename, so the directory date never leaks in."""
    ev = table(spark, sf, "events").select(F.concat(
        F.lit("/landing/events/"), F.date_format("ts", "yyyy-MM"), F.lit("/events_"),
        F.date_format("ts", "yyyy-MM-dd"), F.lit(".json")).alias("_source_file"))
    od = table(spark, sf, "orders").select(F.concat(
        F.lit("/landing/orders/orders_"), F.date_format("o_orderdate", "yyyy-MM"), F.lit(".parquet"))
        .alias("_source_file"))
    srcs = [d.select(batch_key_of("_source_file").alias("batch_key")) for d in (ev, od)]
    return B.discover_batches(*srcs).select("batch_key", business_date("batch_key").alias("business_date"))


def dedup_latest(spark, sf):
    """One row per (user, day): the day's last event."""
    return feeds.staged_users(spark, sf)


def clean_orders(spark, sf):
    """Typed, rule-checked, deduplicated orders (the fact)."""
    return _clean_orders(spark, sf)[0]


def clean_orders_rejects(spark, sf):
    """Order rows rejected by cleaning, with the raw id and the reason."""
    return _clean_orders(spark, sf)[1]


def fact_partitioned(spark, sf):
    """The clean fact written partitioned by year and month, read back."""
    good, _ = _clean_orders(spark, sf)
    path = scratch_dir(spark, "fact-orders")
    layout.write_partitioned(good, path, ["year", "month"])
    back = spark.read.parquet(path)
    return back.select("order_id", "customer_id", "amount", "order_date",
                       F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month"),
                       "batch_key")


def sales_by_city(spark, sf):
    """Read sorted by amount, as the gold reads are (a range-partitioned sort
    of one row per city)."""
    return gold.sales_by(feeds.fact_orders(spark, sf), _current_customers(spark, sf), "customer_id", ["city"],
                         "amount", "order_id", as_of=feeds.AS_OF).orderBy(F.col("total_amount").desc())


def sales_by_category(spark, sf):
    cur = feeds.part_history(spark, sf).filter("is_current")
    return gold.sales_by(feeds.fact_lines(spark, sf), cur, "product_id", ["category"], "amount", "order_id",
                         distinct_key=True, as_of=feeds.AS_OF).orderBy(F.col("total_amount").desc())


def _ranking(spark, sf, n):
    spend = gold.spend_per(feeds.fact_orders(spark, sf), _current_customers(spark, sf), "customer_id",
                           ["name", "city"], "amount")
    return gold.rank_top(spend, "total_amount", "customer_id", n)


def customer_ranking(spark, sf):
    """Top 100 customers by exact total spend (ties: lower id first)."""
    return _ranking(spark, sf, 100)


def customer_top10(spark, sf):
    """Top 10 of the ranking, in rank order."""
    return _ranking(spark, sf, 10).orderBy("ranking")


def join_inner(spark, sf):
    """Customers with their orders."""
    dim, fact = _join_sides(spark, sf)
    return joins.inner(dim, fact, "customer_id")


def join_left(spark, sf):
    """Every customer and prospect, with orders if any."""
    dim, fact = _join_sides(spark, sf)
    return joins.left_outer(dim, fact, "customer_id")


def join_right(spark, sf):
    """Every order, with its customer if known."""
    dim, fact = _join_sides(spark, sf)
    return joins.right_outer(dim, fact, "customer_id")


def join_outer(spark, sf):
    """Both sides, NULL where there is no match."""
    dim, fact = _join_sides(spark, sf)
    return joins.full_outer(dim, fact, "customer_id")


def join_anti(spark, sf):
    """Customers and prospects without orders."""
    dim, fact = _join_sides(spark, sf)
    return joins.anti(dim, fact, "customer_id")


def join_semi(spark, sf):
    """Customers with orders (customer columns only)."""
    dim, fact = _join_sides(spark, sf)
    return joins.semi(dim, fact, "customer_id")


def join_flagged(spark, sf):
    """Staged rows of CHANGE_BATCH joined to the dimension before it, on the
    key AND ``is_current`` (the join inside change detection)."""
    staged = feeds.staged_users(spark, sf)
    dim = scd.scd2(staged.filter(F.col("batch_key") < CHANGE_BATCH), ["user_id"], ["event_type"], "event_date")
    s = staged.filter(F.col("batch_key") == CHANGE_BATCH).alias("s")
    d = dim.alias("d")
    j = s.join(d, (F.col("s.user_id") == F.col("d.user_id")) & F.col("d.is_current"), "inner")
    return j.select(F.col("s.user_id").alias("user_id"), F.col("s.event_type").alias("event_type"),
                    F.col("d.event_type").alias("current_event_type"), F.col("d.valid_from").alias("valid_from"),
                    (~F.col("s.event_type").eqNullSafe(F.col("d.event_type"))).alias("is_change"))


def _versions(spark, sf):
    h = feeds.user_history(spark, sf)
    return (h.filter("is_current").select("user_id", "event_type"),
            h.filter("not is_current").select("user_id", "event_type"))


def union_all(spark, sf):
    """Current and closed versions, by position."""
    cur, old = _versions(spark, sf)
    return cur.unionAll(old)


def union_distinct(spark, sf):
    """Current and closed versions, duplicates removed."""
    cur, old = _versions(spark, sf)
    return cur.union(old).distinct()


def union_by_name(spark, sf):
    """Current and closed versions, matched by column name."""
    cur, old = _versions(spark, sf)
    return cur.unionByName(old.select("event_type", "user_id"))


def check_row_counts(spark, sf):
    """Row counts of the layered tables (Q-1)."""
    good, bad = _clean_orders(spark, sf)
    return checks.row_counts({
        "staged_users": feeds.staged_users(spark, sf),
        "dim_users_type1": scd1_events(spark, sf),
        "dim_users_type2": feeds.user_history(spark, sf),
        "dim_products_type2": feeds.part_history(spark, sf),
        "dim_customers_type2": feeds.customer_dim(spark, sf),
        "fact_orders": good,
        "rejects_orders": bad,
        "sales_by_city": sales_by_city(spark, sf),
        "sales_by_category": sales_by_category(spark, sf),
        "ranking_customers": customer_ranking(spark, sf),
    })


def check_current_versions(spark, sf):
    """Keys without exactly one current version, on a double-loaded copy (Q-2)."""
    return checks.current_version_violations({
        "users_double_loaded": (_double_loaded(spark, sf), "user_id"),
        "products": (feeds.part_history(spark, sf), "product_id"),
    })


def check_open_interval(spark, sf):
    """Current rows with an end date or closed rows without one, on a stale-flag copy (Q-3)."""
    return checks.open_interval_violations({
        "users_stale_flags": (_stale_flags(spark, sf), "user_id"),
        "products": (feeds.part_history(spark, sf), "product_id"),
    })


def check_orphans(spark, sf):
    """Fact rows whose key has no dimension row (Q-4)."""
    good, _ = _clean_orders(spark, sf)
    lines = feeds.fact_lines(spark, sf)
    a = checks.orphans(good, "order_id", {"orphan customer_id": ("customer_id", feeds.customer_dim(spark, sf),
                                                                 "customer_id")})
    b = checks.orphans(lines, "order_id", {"orphan product_id": ("product_id", feeds.part_history(spark, sf),
                                                                 "product_id")})
    return a.unionByName(b)


def check_intervals(spark, sf):
    """Versions that overlap or run backwards, on a double-loaded copy (Q-6)."""
    return checks.interval_violations({
        "users_double_loaded": (_double_loaded(spark, sf), "user_id"),
        "products": (feeds.part_history(spark, sf), "product_id"),
    })


# --- ingestion --------------------------------------------------------------

def _ingest(spark, name, fmt, df, options=None):
    root = scratch_dir(spark, f"ingest-{name}")
    land(df, f"{root}/landing", fmt, by_batch=True)
    spec = B.SourceSpec(name, fmt, f"{root}/landing", options or {})
    B.ingest(spark, spec, f"{root}/bronze", f"{root}/_checkpoint", f"{root}/_schema")
    return root, B.read_bronze(spark, f"{root}/bronze", f"{root}/_schema")


def ingest_json(spark, sf):
    """Customers landed as JSON, ingested by stream, read back typed."""
    c = table(spark, sf, "customer").withColumn("batch_key", F.lit(feeds.CUSTOMER_BATCH))
    _, b = _ingest(spark, "customers", "json", c)
    return b.select(F.col("c_custkey").try_cast("bigint").alias("c_custkey"), "c_name",
                    F.col("c_nationkey").try_cast("int").alias("c_nationkey"),
                    F.col("c_acctbal").try_cast("double").alias("c_acctbal"), "c_mktsegment", "batch_key")


def _orders_landing(spark, sf):
    o = table(spark, sf, "orders")
    return o.withColumn("batch_key", F.date_format("o_orderdate", "yyyy-MM"))


def ingest_parquet(spark, sf):
    """Orders landed as Parquet (one directory per month), ingested, read back typed."""
    _, b = _ingest(spark, "orders", "parquet", _orders_landing(spark, sf))
    return b.select(F.col("o_orderkey").try_cast("bigint").alias("o_orderkey"),
                    F.col("o_custkey").try_cast("bigint").alias("o_custkey"), "o_orderstatus",
                    F.col("o_totalprice").try_cast("double").alias("o_totalprice"),
                    F.to_date(F.col("o_orderdate").try_cast("timestamp_ntz")).alias("order_date"),
                    "o_orderpriority", "batch_key")


def ingest_csv(spark, sf):
    """Parts landed as CSV with a header, ingested, read back typed."""
    p = table(spark, sf, "part").withColumn("batch_key", F.lit(feeds.PRICE_BATCHES[0]))
    _, b = _ingest(spark, "products", "csv", p)
    return b.select(F.col("p_partkey").try_cast("bigint").alias("p_partkey"), "p_name", "p_brand", "p_type",
                    F.col("p_size").try_cast("int").alias("p_size"),
                    F.col("p_retailprice").try_cast("double").alias("p_retailprice"), "batch_key")


def ingest_orc(spark, sf):
    """Suppliers landed as ORC, ingested, read back typed."""
    s = table(spark, sf, "supplier").withColumn("batch_key", F.lit(feeds.CUSTOMER_BATCH))
    _, b = _ingest(spark, "suppliers", "orc", s)
    return b.select(F.col("s_suppkey").try_cast("bigint").alias("s_suppkey"), "s_name",
                    F.col("s_nationkey").try_cast("int").alias("s_nationkey"),
                    F.col("s_acctbal").try_cast("double").alias("s_acctbal"), "batch_key")


def ingest_text(spark, sf):
    """Nations landed as text lines, ingested, split back into columns."""
    n = table(spark, sf, "nation").withColumn("batch_key", F.lit(feeds.CUSTOMER_BATCH))
    _, b = _ingest(spark, "nations", "text", n)
    parts = F.split(F.col("value"), r"\|")
    return b.select(parts[0].try_cast("int").alias("n_nationkey"), parts[1].alias("n_name"),
                    parts[2].try_cast("int").alias("n_regionkey"), "batch_key")


def ingest_evolution(spark, sf):
    """Customers in two drops; the second has a column the first lacked.
    Old rows read back with NULL there; nothing is ingested twice."""
    c = table(spark, sf, "customer")
    first_segments = F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING")
    root = scratch_dir(spark, "ingest-evolution")
    spec = B.SourceSpec("customers", "json", f"{root}/landing")
    args = (f"{root}/bronze", f"{root}/_checkpoint", f"{root}/_schema")
    land(c.filter(first_segments).select("c_custkey", "c_name", F.lit("1995-01").alias("batch_key")),
         spec.path, "json")
    B.ingest(spark, spec, *args)
    land(c.filter(~first_segments).select("c_custkey", "c_name", "c_acctbal", F.lit("1995-02").alias("batch_key")),
         spec.path, "json")
    B.ingest(spark, spec, *args)
    B.ingest(spark, spec, *args)  # nothing new: adds no rows
    b = B.read_bronze(spark, f"{root}/bronze", f"{root}/_schema")
    return b.select(F.col("c_custkey").try_cast("bigint").alias("c_custkey"), "c_name",
                    F.col("c_acctbal").try_cast("double").alias("c_acctbal"), "batch_key")


def ingest_lineage(spark, sf):
    """Rows ingested and first order date per batch (Q-5)."""
    _, b = _ingest(spark, "orders", "parquet", _orders_landing(spark, sf))
    return (b.groupBy("batch_key")
            .agg(F.count(F.lit(1)).alias("rows_ingested"),
                 F.min(F.to_date(F.col("o_orderdate").try_cast("timestamp_ntz"))).alias("first_order_date")))


# --- access, layout ---------------------------------------------------------

def masked_customers(spark, sf):
    """Current customers as an analyst sees them: names masked (F-11)."""
    return access.mask_columns(_current_customers(spark, sf).select("customer_id", "name", "city"),
                               ["name"], ANALYST)


def row_filtered_history(spark, sf):
    """User history as an analyst sees it: current rows only (F-12)."""
    return access.restrict_rows(feeds.user_history(spark, sf), ANALYST)


def compact_orders(spark, sf):
    """Orders rewritten into few files clustered on (customer, date), read back."""
    o = table(spark, sf, "orders")
    path = scratch_dir(spark, "compact-orders")
    layout.compact(o, path, by=["o_custkey", "o_orderdate"])
    back = spark.read.parquet(path)
    return back.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                       F.to_date("o_orderdate").alias("order_date"), "o_orderpriority")


# --- per-batch state ---------------------------------------------------------

def _staged_state(spark, sf, name):
    root = scratch_dir(spark, name)
    rows = feeds.staged_users(spark, sf).select("user_id", "event_type", "event_date", "batch_key")
    layout.write_partitioned(rows, f"{root}/staged", ["batch_key"], gather=True)
    staged = spark.read.schema(rows.schema).parquet(f"{root}/staged")
    return staged, scd.Scd2State(spark, f"{root}/state", feeds.USER_KEYS, feeds.USER_TRACKED, feeds.USER_EFFECTIVE)


def scd2_late_batch(spark, sf):
    """Every batch but one, folded into a base, then the late one: the history
    equals the rebuild (D-9)."""
    staged, state = _staged_state(spark, sf, "scd2-late")
    scd.catch_up(spark, staged.filter(F.col("batch_key") != LATE_BATCH), state)
    state.consolidate(FOLDED_BATCH)
    scd.catch_up(spark, staged, state)
    return state.history_at(state.applied()[-1]).select("user_id", "event_type", "valid_from", "valid_to", "is_current")


def scd2_batch_log(spark, sf):
    """What each applied batch did; the last one re-sends every user's state and
    changes nothing (D-7)."""
    staged, state = _staged_state(spark, sf, "scd2-log")
    scd.catch_up(spark, staged, state)
    last = state.applied()[-1]
    again = state.open_at(last).select("user_id", "event_type", F.col("valid_from").alias("event_date"))
    state.apply("9999-12-31", again, last)
    return state.log().select("batch_key", "closed", "opened", "current")


def state_replayed_at_batch(spark, sf):
    """The per-batch state read as it stood after AS_OF_BATCH, with later batches applied."""
    staged, state = _staged_state(spark, sf, "scd2-asof")
    scd.catch_up(spark, staged, state)
    return state.history_at(AS_OF_BATCH).select("user_id", "event_type", "valid_from", "valid_to", "is_current")


# --- cleaning of the other sources --------------------------------------------

def _with_reasons(good, bad, cols):
    """Accepted rows and rejected ones (raw id and batch) in one table."""
    none = {c: F.lit(None).cast(t) for c, t in good.dtypes if c in cols and c not in bad.columns}
    return good.select(*[F.col(c).cast("string").alias(c) if c in bad.columns else F.col(c) for c in cols],
                       F.lit(None).cast("string").alias("reject_reason")) \
        .unionByName(bad.withColumns(none).select(*cols, "reject_reason"))


def clean_customers(spark, sf):
    """Cleaned and rejected customers (missing names and keys, impossible dates, re-sent rows)."""
    from strata.plans.flow import stage_customers
    return _with_reasons(*stage_customers(feeds.customers_raw(spark, sf)), ["customer_id", "name", "city", "event_date", "batch_key"])


def clean_products(spark, sf):
    """Cleaned and rejected products (amounts out of range, month 13, missing keys)."""
    from strata.plans.flow import stage_products
    return _with_reasons(*stage_products(feeds.products_raw(spark, sf)),
                         ["product_id", "product_name", "price", "launch_date", "batch_key", "business_date"])


# --- more ingestion -----------------------------------------------------------

def ingest_rescued(spark, sf):
    """Customers in two drops; the second has keys the store doesn't know, one of
    them named like an envelope column. Nothing is lost."""
    c = table(spark, sf, "customer")
    root = scratch_dir(spark, "ingest-rescued")
    spec = B.SourceSpec("customers", "json", f"{root}/landing zone")
    args = (f"{root}/bronze", f"{root}/_checkpoint", f"{root}/_schema")
    early = F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING")
    land(c.filter(early).select("c_custkey", "c_name", F.lit("1995-01").alias("batch_key")), spec.path, "json")
    B.ingest(spark, spec, *args)
    extra = F.struct(F.col("c_nationkey").alias("n"), F.col("c_mktsegment").alias("s"))
    land(c.filter(~early).select("c_custkey", "c_name", F.col("c_acctbal").cast("string").alias("epoch"),
                                 F.lit("file").alias("_source_file"), extra.alias("extra"), F.lit("1995-02").alias("batch_key")),
         spec.path, "json")
    B.ingest(spark, spec, *args)
    b = B.read_bronze(spark, args[0], args[2])
    return b.select(F.col("c_custkey").try_cast("bigint").alias("c_custkey"), "c_name", F.col("epoch").try_cast("double").alias("epoch"),
                    F.col("source__source_file").alias("their_source_file"),
                    F.get_json_object("extra", "$.s").alias("segment"), "batch_key")


def ingest_csv_ragged(spark, sf):
    """Parts as CSV lines of which some have a value too many or too few: those
    keep their text, the others their columns."""
    p = table(spark, sf, "part")
    root = scratch_dir(spark, "ingest-ragged")
    size = F.col("p_size")
    line = F.when(size > 40, F.concat_ws(",", "p_partkey", "p_brand", "p_size", F.lit("more"))) \
        .when(size < 5, F.concat_ws(",", "p_partkey", "p_brand")).otherwise(F.concat_ws(",", "p_partkey", "p_brand", "p_size"))
    # one column whose name is the header and whose separator never occurs: lines as they are
    (p.select(line.alias("p_partkey,p_brand,p_size"), F.lit("1995-01").alias("batch_key")).write.partitionBy("batch_key")
     .option("header", "true").option("sep", "\u0001").csv(f"{root}/landing"))
    B.ingest(spark, B.SourceSpec("parts", "csv", f"{root}/landing"), f"{root}/bronze", f"{root}/_checkpoint", f"{root}/_schema")
    b = B.read_bronze(spark, f"{root}/bronze", f"{root}/_schema")
    return b.select(F.col("p_partkey").try_cast("bigint").alias("p_partkey"), "p_brand", F.col("p_size").try_cast("int").alias("p_size"),
                    F.col("_corrupt_record").alias("broken_line"))


def ingest_files(spark, sf):
    """Rows per source file (Q-5, S-10, H-6): the file's directory and kind, as
    the writer's part numbers aren't fixed."""
    _, b = _ingest(spark, "orders", "parquet", _orders_landing(spark, sf))
    per_file = checks.lineage(b, by_basename=False)
    parts = F.regexp_extract("source_file", r"/(batch_key=[^/]+)/part-[^/]*?(\.[a-z]+)*$", 1)
    return per_file.filter(F.col("ingested_at").isNotNull()).groupBy(parts.alias("directory")).agg(F.sum("rows_ingested").alias("rows_ingested"))


# --- ordered reads, views, layout ---------------------------------------------

def history_sorted(spark, sf):
    """Full history in (user, start) order with each row's position (H-2, O-1)."""
    return ordered.with_positions(feeds.user_history(spark, sf), [F.col("user_id"), F.col("valid_from")])


def sales_sorted(spark, sf):
    """Category sales by amount, largest first, with each row's position (H-7, O-2)."""
    return ordered.with_positions(sales_by_category(spark, sf), [F.col("total_amount").desc(), F.col("category")])


def orders_limit(spark, sf):
    """The 25 largest orders: sort and limit, a top-k without a full sort (O-3)."""
    return (feeds.fact_orders(spark, sf).orderBy(F.col("amount").desc(), F.col("order_id")).limit(25))


def sql_functions(spark, sf):
    """The mask and row filter as SQL functions over a named view (G-1, S-17)."""
    access.register_sql_functions(spark)
    feeds.customer_dim(spark, sf).createOrReplaceTempView("strata_customers")
    return spark.sql("""SELECT customer_id, mask_pii_name(name, :role) AS name, city FROM strata_customers
                        WHERE filter_current_only(is_current, :role)""", args={"role": ANALYST})


def fact_refreshed(spark, sf):
    """A dynamic overwrite replaces only the partitions it brings (S-14)."""
    good, _ = _clean_orders(spark, sf)
    path = scratch_dir(spark, "fact-refreshed")
    layout.write_partitioned(good, path, ["year", "month"], gather=True)
    again = good.filter(F.col("year") == REFRESH_YEAR).withColumn("amount", F.col("amount") + 1)
    layout.write_partitioned(again, path, ["year", "month"], dynamic=True, gather=True)
    return spark.read.schema(good.schema).parquet(path).select(*good.columns)


def compact_partitioned(spark, sf):
    """A table of many small files per partition, compacted and clustered within its partitions."""
    o = table(spark, sf, "orders")
    root = scratch_dir(spark, "compact-partitioned")
    o.write.partitionBy("o_orderstatus").parquet(f"{root}/raw")
    layout.compact(spark.read.parquet(f"{root}/raw"), f"{root}/packed", by=["o_orderpriority", "o_custkey"], partition_by=["o_orderstatus"])
    back = spark.read.parquet(f"{root}/packed")
    return back.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                       F.to_date("o_orderdate").alias("order_date"), "o_orderpriority")


def ingest_manifest(spark, sf):
    """Orders in three drops, the last micro-batch run twice as if it had ended
    before its commit: per month, the rows and the epoch that the manifest has for
    its files, rows whose file it doesn't have, and files it has twice (S-8, Q-5)."""
    root = scratch_dir(spark, "ingest-manifest")
    spec = B.SourceSpec("orders", "parquet", f"{root}/landing")
    args = (f"{root}/bronze", f"{root}/_checkpoint", f"{root}/_schema")
    rows = _orders_landing(spark, sf)
    year = F.year("o_orderdate")
    for drop in (year < DROP_YEARS[0], (year >= DROP_YEARS[0]) & (year < DROP_YEARS[1]), year >= DROP_YEARS[1]):
        land(rows.filter(drop), spec.path, "parquet", by_batch=True)
        B.ingest(spark, spec, *args)
    delete_path(spark, f"{args[1]}/commits/2")
    B.ingest(spark, spec, *args)
    files = B.manifest(spark, args[0]).groupBy("file").agg(F.count(F.lit(1)).alias("times"), F.max("epoch").alias("epoch"))
    # the stream's names are plain, a row's are percent-encoded
    name = F.regexp_replace(F.url_decode(F.regexp_replace("_source_file", r"\+", "%2B")), r"^file:(//)?/", "file:/")
    per_file = B.read_bronze(spark, args[0], args[2]).groupBy("batch_key", name.alias("file")).agg(F.count(F.lit(1)).alias("rows"))
    return (per_file.join(files, "file", "left").groupBy("batch_key")
            .agg(F.sum("rows").alias("rows_ingested"), F.max("epoch").alias("epoch"),
                 F.sum(F.when(F.col("times").isNull(), F.col("rows")).otherwise(0)).alias("rows_without_file"),
                 F.count(F.when(F.col("times") > 1, 1)).alias("files_twice")))


def ingest_mixed_case(spark, sf):
    """Customers as JSON whose keys differ in case between drops and within one,
    with a dotted and an empty key, and with two spellings in one record (S-1, S-6, S-7)."""
    c = table(spark, sf, "customer")
    root = scratch_dir(spark, "ingest-mixed-case")
    spec = B.SourceSpec("customers", "json", f"{root}/landing")
    args = (f"{root}/bronze", f"{root}/_checkpoint", f"{root}/_schema")
    early = F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING")

    def record(*pairs):
        return F.to_json(F.map_from_entries(F.array(*[F.struct(F.lit(k), v.cast("string")) for k, v in pairs])))

    first = record(("custKey", F.col("c_custkey")), ("c.name", F.col("c_name")), ("", F.col("c_mktsegment")))
    later = record(("CUSTKEY", F.col("c_custkey")), ("custkey", -F.col("c_custkey")), ("C.Name", F.col("c_name")), ("Balance", F.col("c_acctbal")))
    for rows, value, batch in ((c.filter(early), first, "1995-01"), (c.filter(~early), later, "1995-02")):
        rows.select(value.alias("value"), F.lit(batch).alias("batch_key")).write.mode("append").partitionBy("batch_key").text(spec.path)
        B.ingest(spark, spec, *args)
    b = B.read_bronze(spark, args[0], args[2])
    return b.select(F.col("custKey").try_cast("bigint").alias("customer_id"), F.col("`c.name`").alias("name"), F.col("source_").alias("segment"),
                    F.col("Balance").try_cast("double").alias("balance"),
                    F.get_json_object("_rescued_data", "$.custkey").try_cast("bigint").alias("other_spelling"), "batch_key")


def ingest_variant(spark, sf):
    """Customers as JSON records kept whole: keys that differ in case, a dotted
    and an empty key, and a value whose type changes between drops (S-6, S-7)."""
    c = table(spark, sf, "customer")
    root = scratch_dir(spark, "ingest-variant")
    spec = B.SourceSpec("customers", "json", f"{root}/landing", {"singleVariantColumn": "record"})
    args = (f"{root}/bronze", f"{root}/_checkpoint", f"{root}/_schema")
    early = F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING")
    quoted = F.to_json(F.struct(F.col("c_name").alias("n")))  # a JSON string, taken out of its object
    name = F.expr("substring(q, 6, length(q) - 6)")
    first = F.format_string('{"Key": %d, "c.name": %s, "": "none", "balance": %d}', "c_custkey", name, F.round("c_acctbal").cast("bigint"))
    later = F.format_string('{"KEY": "%d", "C.Name": %s, "balance": %s}', "c_custkey", name,
                            F.when(F.col("c_mktsegment") == "MACHINERY", '{"amount": 1}').otherwise(
                                F.concat(F.lit('"'), F.col("c_acctbal").cast("decimal(12,2)").cast("string"), F.lit('"'))))
    for rows, value, batch in ((c.filter(early), first, "1995-01"), (c.filter(~early), later, "1995-02")):
        (rows.withColumn("q", quoted).select(value.alias("value"), F.lit(batch).alias("batch_key"))
         .write.mode("append").partitionBy("batch_key").text(spec.path))
        B.ingest(spark, spec, *args)
    whole = B.read_bronze(spark, args[0], args[2])
    types = {"key": "bigint", "c.name": "string", "": "string", "balance": "double"}
    b = variants.fields(whole, "record", types).toDF(*whole.columns, "customer_id", "name", "unnamed", "balance", "unfit")
    upper = F.startswith(F.schema_of_variant("record"), F.lit("OBJECT<C.Name")) | F.startswith(F.schema_of_variant("record"), F.lit("OBJECT<`C.Name"))
    return b.select("customer_id", "name", "unnamed", "balance", F.array_join("unfit", ",").alias("unfit"), upper.alias("upper_keys"), "batch_key")


def ingest_csv_options(spark, sf):
    """Parts as CSV with another separator and quote and values over two lines,
    typed by SQL expressions, old ones filtered by age and day (S-5, P-2, X-12)."""
    root = scratch_dir(spark, "ingest-csv-options")
    p = table(spark, sf, "part")
    landed = p.select("p_partkey", F.concat_ws("\n", "p_name", "p_brand").alias("label"),
                      F.concat(F.lit("a;b'"), F.col("p_size").cast("string")).alias("note"),
                      F.date_add(F.lit(RETENTION_START).cast("date"), F.col("p_size")).alias("seen"), F.lit("1995-01").alias("batch_key"))
    landed.write.partitionBy("batch_key").options(header=True, sep=";", quote="'", escape="'").csv(f"{root}/landing")
    spec = B.SourceSpec("parts", "csv", f"{root}/landing", {"sep": ";", "quote": "'", "escape": "'", "multiLine": "true"})
    B.ingest(spark, spec, f"{root}/bronze", f"{root}/_checkpoint", f"{root}/_schema")
    typed = C.typed(B.read_bronze(spark, f"{root}/bronze", f"{root}/_schema"), [
        "TRY_CAST(p_partkey AS BIGINT) AS p_partkey", "split(label, '\n')[0] AS p_name", "split(label, '\n')[1] AS p_brand", "note",
        "TRY_TO_DATE(seen) AS seen"])
    # kept for RETENTION_DAYS, and for good if seen on the first ten days of a month
    kept = (F.date_add("seen", RETENTION_DAYS) >= F.lit(RETENTION_END).cast("date")) | (F.dayofmonth("seen") <= 10)
    return typed.filter(kept).withColumn("expires", F.date_add("seen", RETENTION_DAYS))


def write_metrics(spark, sf):
    """Rows and NULLs per column of three tables, out of their writes (A-9, Q-1)."""
    root = scratch_dir(spark, "write-metrics")
    good, bad = _clean_orders(spark, sf)
    tables = {"fact_orders": good, "rejects_orders": bad, "dim_customers": feeds.customer_dim(spark, sf)}
    rows = [(name, metric, n) for name, df in tables.items() for metric, n in checks.write_observed(df, f"{root}/{name}").items()]
    return spark.createDataFrame(rows, "table_name string, metric string, value long")


def schema_report(spark, sf):
    """Tables written under older schemas against the declared ones: each column's
    status, and how many of the values read as declared are not NULL (S-15)."""
    root = scratch_dir(spark, "schema-report")
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    day = F.to_date("o_orderdate")
    older = {
        "fact_orders": o.select(F.col("o_orderkey").cast("int").alias("ORDER_ID"), F.col("o_custkey").cast("string").alias("customer_id"),
                                F.col("o_totalprice").cast("string").alias("amount"), day.alias("order_date"),
                                F.year(day).alias("year"), F.month(day).alias("month"), "o_orderpriority"),
        "dim_customers_type1": c.select(F.col("c_custkey").cast("int").alias("customer_id"), F.col("c_name").alias("name"),
                                        F.when(F.col("c_mktsegment") == "BUILDING", "1995-02-31").otherwise("1995-02-01").alias("update_date")),
    }
    out = None
    for name, df in older.items():
        declared, parts = schemas.SCHEMAS[name]
        df.write.parquet(f"{root}/{name}")
        schemas.ensure_table(spark, f"{root}/{name}", declared, parts)  # exists: left alone
        there = spark.read.parquet(f"{root}/{name}")
        report = spark.createDataFrame(schemas.compare_schema(there.schema, declared), "column_name string, status string, was string, declared string")
        back = schemas.as_declared(there, declared)
        filled = back.agg(*[F.count(f.name).alias(f.name) for f in declared]).select(
            F.explode(F.array(*[F.struct(F.lit(f.name).alias("column_name"), F.col(f.name).alias("filled")) for f in declared])).alias("f")).select("f.*")
        one = report.join(filled, "column_name", "left").select(F.lit(name).alias("table_name"), "column_name", "status", "was", "declared", "filled")
        out = one if out is None else out.unionByName(one)
    return out


# --- state that changes in place, streams, co-located tables ---------------------

def upsert_buckets(spark, sf):
    """Type 1 state of every user up to a day in hash buckets, then the later days
    merged in one by one, each recorded; the last one is sent twice (D-1)."""
    staged = feeds.staged_users(spark, sf).persist()
    table_ = merge.BucketedTable(spark, scratch_dir(spark, "upsert-buckets"), ["user_id"], buckets=16)
    cols = ["user_id", "event_type", "update_date", "n_updates"]
    first = scd.scd1(staged.filter(F.col("batch_key") <= UPSERT_SPLIT), ["user_id"], ["event_type"], "event_date")
    table_.create(first.withColumn("n_updates", F.lit(0).cast("long")).select(*cols))
    days = [r[0] for r in staged.select("batch_key").distinct().filter(F.col("batch_key") > UPSERT_SPLIT).orderBy("batch_key").collect()]
    days = [days[:len(days) // 2], days[len(days) // 2:]]
    for epoch, part in ((0, days[0]), (1, days[1]), (1, days[1])):
        late = staged.filter(F.col("batch_key").isin(part))
        source = scd.scd1(late, ["user_id"], ["event_type"], "event_date").select("user_id", "event_type", "update_date")
        table_.upsert(source, {"event_type": "source.event_type", "update_date": "source.update_date", "n_updates": "target.n_updates + 1"},
                      {"user_id": "source.user_id", "event_type": "source.event_type", "update_date": "source.update_date", "n_updates": "0L"}, epoch)
    staged.unpersist()
    return table_.rows()


def fingerprint_changes(spark, sf):
    """Users' history folded at a batch, then the later batches applied in two steps
    with what they repeat found by fingerprints; what each batch did (D-4, D-7)."""
    staged, state = _staged_state(spark, sf, "fingerprints")
    batches = [r[0] for r in staged.select("batch_key").distinct().orderBy("batch_key").collect()]
    early = [b for b in batches if b <= UPSERT_SPLIT]
    scd.replay(spark, staged, early, state)
    state.consolidate(early[-1])
    late = batches[len(early):]
    previous = early[-1]
    for part in (late[:len(late) // 2], late[len(late) // 2:]):
        if part:
            state.apply_all(staged.filter(F.col("batch_key").isin(part)), part, previous)
            previous = part[-1]
    return state.log().select("batch_key", "opened", "closed", "current")


def net_changes(spark, sf):
    """Each user's net change between two batches, with both images; read from the
    deltas of the batches in between only (H-5)."""
    staged, state = _staged_state(spark, sf, "net-changes")
    batches = [r[0] for r in staged.select("batch_key").distinct().orderBy("batch_key").collect()]
    scd.replay(spark, staged, batches, state)
    return state.changes_between(AS_OF_BATCH, CHANGE_BATCH)


def stream_history(spark, sf):
    """Events streamed straight into the users' versioned state in three drops; the
    second is stopped between applying it and its record, and run again (T-1, D-5)."""
    root = scratch_dir(spark, "stream-history")
    events = feeds.user_feed(spark, sf)
    state = scd.Scd2State(spark, f"{root}/state", feeds.USER_KEYS, feeds.USER_TRACKED, feeds.USER_EFFECTIVE)
    schema = events.drop("batch_key").schema

    def stage(rows):
        return C.dedup_latest(rows, ["user_id", "batch_key"], ["ts", "event_id"]).select("user_id", "batch_key", "event_id", "event_type", "event_date")

    def stop(epoch):
        raise _Stopped(epoch)

    third = F.pmod(F.col("event_id"), F.lit(3))  # every day comes in parts
    for drop in range(3):
        land(events.filter(third == drop), f"{root}/landing", "parquet", by_batch=True)
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{root}/landing")
        stream = stream.withColumn("batch_key", F.date_format("ts", "yyyy-MM-dd"))
        if drop == 1:
            try:
                StateSink(spark, f"{root}/sink", state, stage, on_apply=stop).drain(stream, f"{root}/checkpoint")
            except StreamingQueryException:
                pass
        StateSink(spark, f"{root}/sink", state, stage).drain(stream, f"{root}/checkpoint")
    return state.history_at(state.applied()[-1]).select("user_id", "event_type", "valid_from", "valid_to", "is_current")


def join_bucketed(spark, sf):
    """Current customers and their orders from tables bucketed alike: no shuffle
    of either side (J-1, S-13)."""
    root, name = scratch_dir(spark, "join-bucketed"), f"strata_{uuid.uuid4().hex[:12]}"
    dim, fact = _join_sides(spark, sf)
    d = layout.write_bucketed(dim, f"{name}_dim", f"{root}/dim", ["customer_id"], 8)
    f = layout.write_bucketed(fact, f"{name}_fact", f"{root}/fact", ["customer_id"], 8)
    return f.hint("merge").join(d, "customer_id").select("customer_id", "name", "city", "order_id", "amount")


# --- the daily run, and what it is made of --------------------------------------

class _Stopped(Exception):
    """A run that ends where the query wants it to."""


def _stopping_at(step: str):
    def on_step(name: str) -> None:
        if name == step:
            raise _Stopped(name)

    return on_step


def incremental_recovered(spark, sf):
    """The daily run over two drops; the second is stopped after staging, after
    the first dimension and before the sums, and run again each time (D-9, T-2).
    Sales by category as the last run leaves them."""
    root = scratch_dir(spark, "incremental-recovered")
    orders = feeds.flow_orders(spark, sf).persist()
    customers, products = feeds.flow_customers(spark, sf), feeds.flow_products(spark, sf)
    landing = flow.Landing(B.SourceSpec("customers", "json", f"{root}/landing/customers"),
                           B.SourceSpec("products", "csv", f"{root}/landing/products"),
                           B.SourceSpec("orders", "parquet", f"{root}/landing/orders"))
    early = F.substring("batch_key", 1, 4).cast("int") < feeds.SECOND_DROP
    late_price = F.col("batch_key") == feeds.PRICE_BATCHES[-1]
    sent = orders.drop("again")
    land(customers.filter(F.col("batch_key") == feeds.CUSTOMER_BATCHES[0]), landing.customers.path, "json", by_batch=True)
    land(products.filter(~late_price), landing.products.path, "csv", by_batch=True)
    land(sent.filter(early), landing.orders.path, "parquet", by_batch=True)
    flow.run_incremental(spark, landing, f"{root}/lake", feeds.AS_OF)
    land(customers.filter(F.col("batch_key") != feeds.CUSTOMER_BATCHES[0]), landing.customers.path, "json", by_batch=True)
    land(products.filter(late_price), landing.products.path, "csv", by_batch=True)
    land(sent.filter(~early).unionByName(feeds.flow_resent(orders).drop("again")), landing.orders.path, "parquet", by_batch=True)
    for step in ("silver/dim_customers_type1", "silver/dim_customers_type2", "state/sums_customers"):
        try:
            flow.run_incremental(spark, landing, f"{root}/lake", feeds.AS_OF, on_step=_stopping_at(step))
        except _Stopped:
            pass
    orders.unpersist()
    return flow.run_incremental(spark, landing, f"{root}/lake", feeds.AS_OF)["sales_by_category"]


def _flow_facts(spark, sf):
    """The fact before and after the second drop, as typed rows by month."""
    orders = feeds.flow_orders(spark, sf)
    again = feeds.flow_resent(orders)

    def fact(rows: DataFrame) -> DataFrame:
        return flow.fact_of(rows.select(*[F.expr(e) for e in flow.ORDER_TYPES]))

    return fact(orders), fact(orders.unionByName(again))


def sales_refreshed(spark, sf):
    """Sales by city from sums kept per month: orders that were re-sent leave
    their months, only the months they left or entered are summed again, and a
    month that was emptied is retracted (A-1, A-2)."""
    root = scratch_dir(spark, "sales-refreshed")
    before, after = _flow_facts(spark, sf)
    gone = before.unionByName(after).filter(f"year = {EMPTIED[0]} AND month = {EMPTIED[1]}").select("order_id").distinct()
    after = after.join(gone, "order_id", "left_anti").select(*before.columns)
    before = publish(before, f"{root}/fact", flow.MONTH)
    progress = Progress(spark, f"{root}/progress")
    months = {flow._month(r["year"], r["month"]): 1 for r in before.select(*flow.MONTH).distinct().collect()}
    flow.refresh_sums(spark, f"{root}/sums", before, "customer_id", months, progress)
    after = publish(after, f"{root}/fact", flow.MONTH)
    # months that the re-sent orders left or entered, and the emptied one (its re-sent orders left others)
    moved = feeds.flow_resent(feeds.flow_orders(spark, sf)).select(F.to_date("order_date").alias("d"))
    touched = moved.select(F.explode(F.array("d", F.add_months("d", -1))).alias("d")).select(F.year("d").alias("y"), F.month("d").alias("m")).distinct()
    for r in [*touched.collect(), Row(y=EMPTIED[0], m=EMPTIED[1])]:
        months[flow._month(r["y"], r["m"])] = 2
    sums = flow.refresh_sums(spark, f"{root}/sums", after, "customer_id", months, progress)
    customers = scd.scd2(feeds.flow_customers(spark, sf), ["customer_id"], ["name", "city"], "event_date")
    return gold.sales_from(gold.merged_sums(sums, "customer_id"), customers.filter("is_current"), "customer_id", ["city"], as_of=feeds.AS_OF)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "pit_revenue_by_type": pit_revenue_by_type,
    "scd2_events_history": scd2_events_history,
    "scd2_events_current": scd2_events_current,
    "scd2_events_replay": scd2_events_replay,
    "scd2_part_price_history": scd2_part_price_history,
    "scd2_part_price_replay": scd2_part_price_replay,
    "scd1_events": scd1_events,
    "scd1_events_replay": scd1_events_replay,
    "upsert_events": upsert_events,
    "close_changed": close_changed,
    "state_as_of_date": state_as_of_date,
    "state_as_of_batch": state_as_of_batch,
    "batch_change_log": batch_change_log,
    "discover_batches": discover_batches,
    "dedup_latest": dedup_latest,
    "clean_orders": clean_orders,
    "clean_orders_rejects": clean_orders_rejects,
    "fact_partitioned": fact_partitioned,
    "sales_by_city": sales_by_city,
    "sales_by_category": sales_by_category,
    "customer_ranking": customer_ranking,
    "customer_top10": customer_top10,
    "join_inner": join_inner,
    "join_left": join_left,
    "join_right": join_right,
    "join_outer": join_outer,
    "join_anti": join_anti,
    "join_semi": join_semi,
    "join_flagged": join_flagged,
    "union_all": union_all,
    "union_distinct": union_distinct,
    "union_by_name": union_by_name,
    "check_row_counts": check_row_counts,
    "check_current_versions": check_current_versions,
    "check_open_interval": check_open_interval,
    "check_orphans": check_orphans,
    "check_intervals": check_intervals,
    "ingest_json": ingest_json,
    "ingest_parquet": ingest_parquet,
    "ingest_csv": ingest_csv,
    "ingest_orc": ingest_orc,
    "ingest_text": ingest_text,
    "ingest_evolution": ingest_evolution,
    "ingest_lineage": ingest_lineage,
    "masked_customers": masked_customers,
    "row_filtered_history": row_filtered_history,
    "compact_orders": compact_orders,
    "scd2_late_batch": scd2_late_batch,
    "scd2_batch_log": scd2_batch_log,
    "state_replayed_at_batch": state_replayed_at_batch,
    "clean_customers": clean_customers,
    "clean_products": clean_products,
    "ingest_rescued": ingest_rescued,
    "ingest_csv_ragged": ingest_csv_ragged,
    "ingest_files": ingest_files,
    "history_sorted": history_sorted,
    "sales_sorted": sales_sorted,
    "orders_limit": orders_limit,
    "sql_functions": sql_functions,
    "fact_refreshed": fact_refreshed,
    "compact_partitioned": compact_partitioned,
    "ingest_variant": ingest_variant,
    "ingest_csv_options": ingest_csv_options,
    "write_metrics": write_metrics,
    "schema_report": schema_report,
    "upsert_buckets": upsert_buckets,
    "fingerprint_changes": fingerprint_changes,
    "net_changes": net_changes,
    "stream_history": stream_history,
    "join_bucketed": join_bucketed,
    "ingest_manifest": ingest_manifest,
    "ingest_mixed_case": ingest_mixed_case,
    "incremental_recovered": incremental_recovered,
    "sales_refreshed": sales_refreshed,
}
