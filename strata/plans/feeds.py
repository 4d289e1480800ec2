"""Source feeds derived from the driver's tables.

The reference's sources are a customer feed with monthly batches, a product
feed whose prices change between batches, and an order feed. Here Spark
derives the same shapes from the test tables, by fixed rules, over whole
tables (the work grows with the data):

* ``events`` is a natural attribute-change stream: a user's state is the
  ``event_type`` of their last event of the day; one batch per day.
* ``part`` becomes a product price list delivered in three batches.
* ``orders`` becomes an all-string raw order feed with dirty values and
  re-sent rows, to exercise cleaning and dedup.
* ``customer`` + ``nation`` become the customer dimension (city = nation).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.columns import business_date
from strata.operators import scd
from strata.operators.clean import dedup_latest
from strata.sources.tables import table

# Fixed values of the derived product price list (money in decimal(12,2)):
#   batch 1995-01 (business date 1995-01-01): list price
#   batch 1998-07 (business date 1998-07-01): list price minus 50.00 for parts of size over 25
#   batch 2000-01 (business date 2000-01-01): as 1998-07, but parts of size over 40 back at list price
PRICE_BATCHES = ("1995-01", "1998-07", "2000-01")
PRICE_CUT = 50
CUT_SIZE = 25
RESTORE_SIZE = 40

# Fixed values of the raw order feed's dirty rows (by status and priority):
#   status P, priority 1-URGENT:        order_id prefixed "ord-" (not an integer)
#   status P, priority 2-HIGH:          order_date on day 31 of its month (invalid in short months)
#   status P, priority 3-MEDIUM:        amount missing
#   status P, priority 4-NOT SPECIFIED: customer_id missing
#   status P, priority 5-LOW:           amount negative
#   status F, priority 5-LOW:           re-sent in the next month's batch with amount + 1
# The customer dimension has two batches, each effective on the first of its
# month: 1995-01, and 1997-06, in which customers of MOVING_SEGMENT move to the
# nation with the next key (of 25).
CUSTOMER_BATCHES = ("1995-01", "1997-06")
CUSTOMER_BATCH = CUSTOMER_BATCHES[0]
MOVING_SEGMENT, NATIONS = "MACHINERY", 25
AS_OF = "2002-01-01"


def user_feed(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events")
    return ev.select("user_id", "event_type", "ts", "event_id",
                     F.date_format("ts", "yyyy-MM-dd").alias("batch_key"),
                     F.to_date("ts").alias("event_date"))


def staged_users(spark: SparkSession, sf: str) -> DataFrame:
    """One row per (user, day): the day's last event (ties: higher event_id)."""
    d = dedup_latest(user_feed(spark, sf), ["user_id", "batch_key"], ["ts", "event_id"])
    return d.select("user_id", "batch_key", "event_id", "event_type", "event_date")


USER_KEYS, USER_TRACKED, USER_EFFECTIVE = ["user_id"], ["event_type"], "event_date"


def user_history(spark: SparkSession, sf: str, **kw) -> DataFrame:
    return scd.scd2(staged_users(spark, sf), USER_KEYS, USER_TRACKED, USER_EFFECTIVE, **kw)


def part_feed(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    base = F.col("p_retailprice").cast("decimal(12,2)")
    cut = F.when(F.col("p_size") > CUT_SIZE, base - PRICE_CUT).otherwise(base)
    restored = F.when(F.col("p_size") > RESTORE_SIZE, base).otherwise(cut)
    # one scan of part, three batches
    rows = F.explode(F.array(
        F.struct(F.lit(PRICE_BATCHES[0]).alias("batch_key"), base.cast("double").alias("price")),
        F.struct(F.lit(PRICE_BATCHES[1]).alias("batch_key"), cut.cast("double").alias("price")),
        F.struct(F.lit(PRICE_BATCHES[2]).alias("batch_key"), restored.cast("double").alias("price")),
    ))
    out = p.select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
                   F.col("p_type").alias("category"), rows.alias("b"))
    return out.select("product_id", "product_name", "category", "b.batch_key", "b.price",
                      business_date(F.col("b.batch_key")).alias("business_date"))


PART_KEYS, PART_TRACKED = ["product_id"], ["product_name", "category", "price"]


def part_history(spark: SparkSession, sf: str, **kw) -> DataFrame:
    return scd.scd2(part_feed(spark, sf), PART_KEYS, PART_TRACKED, "business_date", **kw)


def customer_feed(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    n = table(spark, sf, "nation")  # small: Spark broadcasts it by its size
    moved = F.when(F.col("c_mktsegment") == MOVING_SEGMENT, (F.col("c_nationkey") + 1) % NATIONS).otherwise(F.col("c_nationkey"))
    homes = F.explode(F.array(
        F.struct(F.lit(CUSTOMER_BATCHES[0]).alias("batch_key"), F.col("c_nationkey").cast("int").alias("home")),
        F.struct(F.lit(CUSTOMER_BATCHES[1]).alias("batch_key"), moved.cast("int").alias("home"))))
    rows = c.select("c_custkey", "c_name", "c_mktsegment", homes.alias("b"))  # one scan, two batches
    return (rows.join(n, F.col("b.home") == n["n_nationkey"])
            .select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name"),
                    F.col("n_name").alias("city"), F.col("c_mktsegment").alias("segment"), "b.batch_key",
                    business_date(F.col("b.batch_key")).alias("event_date")))


def customer_dim(spark: SparkSession, sf: str) -> DataFrame:
    return scd.scd2(customer_feed(spark, sf), ["customer_id"], ["name", "city"], "event_date",
                    carry=["segment"])


def orders_raw(spark: SparkSession, sf: str) -> DataFrame:
    """All-string order feed with dirty rows and re-sent rows (one scan)."""
    o = table(spark, sf, "orders")
    pst = F.col("o_orderstatus") == "P"
    prio = F.col("o_orderpriority")
    key = F.col("o_orderkey").cast("string")
    month = F.date_format("o_orderdate", "yyyy-MM")
    first = F.struct(
        F.when(pst & (prio == "1-URGENT"), F.concat(F.lit("ord-"), key)).otherwise(key).alias("order_id"),
        F.when(pst & (prio == "4-NOT SPECIFIED"), F.lit(None).cast("string"))
        .otherwise(F.col("o_custkey").cast("string")).alias("customer_id"),
        F.when(pst & (prio == "3-MEDIUM"), F.lit(None).cast("string"))
        .when(pst & (prio == "5-LOW"), (-F.col("o_totalprice")).cast("string"))
        .otherwise(F.col("o_totalprice").cast("string")).alias("amount"),
        F.when(pst & (prio == "2-HIGH"), F.concat(month, F.lit("-31")))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("order_date"),
        month.alias("batch_key"))
    resend = F.when((F.col("o_orderstatus") == "F") & (prio == "5-LOW"), F.struct(
        key.alias("order_id"), F.col("o_custkey").cast("string").alias("customer_id"),
        (F.col("o_totalprice") + 1).cast("string").alias("amount"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
        F.date_format(F.add_months(F.to_date("o_orderdate"), 1), "yyyy-MM").alias("batch_key")))
    rows = F.filter(F.array(first, resend), lambda r: r.isNotNull())
    return o.select(F.explode(rows).alias("r")).select("r.*")


def prospects(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as customers that have not ordered yet, under negative ids."""
    s, n = table(spark, sf, "supplier"), table(spark, sf, "nation")
    return s.join(n, s["s_nationkey"] == n["n_nationkey"]).select(
        (-1 - F.col("s_suppkey")).cast("long").alias("customer_id"), F.col("s_name").alias("name"), F.col("n_name").alias("city"))


# Fixed values of the raw customer and product feeds' dirty rows:
#   customers: MACHINERY has no name; HOUSEHOLD has day 31 in February as its
#     event date; FURNITURE has no batch key; BUILDING is sent twice, the later
#     row in city "MOVED"
#   products (by size): 1 price "Infinity", 2 price "1e20", 3 price "-1", 4 no
#     price, 5 batch key 2026-13, 6 no batch key, 7 no product id, 8 launch date
#     that is none
def customers_raw(spark: SparkSession, sf: str) -> DataFrame:
    """All-string customer feed with dirty and re-sent rows (one scan)."""
    seg = F.col("c_mktsegment")

    def row(city, day):
        return F.struct(F.concat(F.lit("0"), F.col("c_custkey").cast("string")).alias("customer_id"),
                        F.when(seg != "MACHINERY", F.col("c_name")).alias("name"), city.alias("city"),
                        F.when(seg == "HOUSEHOLD", F.lit("1995-02-31")).otherwise(F.lit(day)).alias("event_date"),
                        F.when(seg != "FURNITURE", F.lit("1995-02")).alias("batch_key"))

    home = F.concat(F.lit("nation "), F.col("c_nationkey").cast("string"))
    sent = F.filter(F.array(row(home, "1995-02-01"), F.when(seg == "BUILDING", row(F.lit("MOVED"), "1995-02-02"))), lambda r: r.isNotNull())
    return table(spark, sf, "customer").select(F.explode(sent).alias("r")).select("r.*")


def products_raw(spark: SparkSession, sf: str) -> DataFrame:
    """All-string product feed with dirty rows."""
    size, key = F.col("p_size"), F.col("p_partkey").cast("string")
    price = (F.when(size == 1, "Infinity").when(size == 2, "1e20").when(size == 3, "-1").when(size == 4, F.lit(None))
             .otherwise(F.col("p_retailprice").cast("string")))
    batch = F.when(size == 5, "2026-13").when(size == 6, F.lit(None)).otherwise(F.lit("2026-01"))
    return table(spark, sf, "part").select(
        F.when(size != 7, key).alias("product_id"), F.col("p_name").alias("product_name"), F.col("p_type").alias("category"),
        price.alias("price"), F.when(size == 8, "soon").otherwise("2026-01-01").alias("launch_date"), batch.alias("batch_key"))


def fact_orders(spark: SparkSession, sf: str) -> DataFrame:
    """The typed order fact: (order_id, customer_id, amount)."""
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_id"),
                                             F.col("o_custkey").alias("customer_id"),
                                             F.col("o_totalprice").alias("amount"))


def fact_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Line-level fact: (order_id, product_id, amount)."""
    return table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("order_id"),
                                               F.col("l_partkey").alias("product_id"),
                                               F.col("l_extendedprice").alias("amount"))


# The landing files of the layered flow, in two drops. Batches are years (their
# January). The second drop has the customers' second batch, the products' third,
# the orders from SECOND_DROP on, and the orders of RESENT_STATUS with priority
# 5-LOW again, a month later and with amount + 1, in their first batch.
SECOND_DROP, RESENT_STATUS = 1997, "F"


def flow_customers(spark: SparkSession, sf: str) -> DataFrame:
    return customer_feed(spark, sf).select("customer_id", "name", "city", "event_date", "batch_key")


def flow_products(spark: SparkSession, sf: str) -> DataFrame:
    return part_feed(spark, sf).select("product_id", "product_name", "category", "price",
                                       F.col("business_date").alias("launch_date"), "batch_key")


def flow_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with the least part of their lines (some have none); ``again`` marks what is sent twice."""
    part = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_partkey").alias("l_partkey"))
    o = table(spark, sf, "orders").join(part, "o_orderkey", "left")
    return o.select(F.col("o_orderkey").cast("string").alias("order_id"), F.col("o_custkey").cast("string").alias("customer_id"),
                    F.col("l_partkey").cast("string").alias("product_id"), F.col("o_totalprice").cast("string").alias("amount"),
                    F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"), F.concat(F.year("o_orderdate"), F.lit("-01")).alias("batch_key"),
                    ((F.col("o_orderstatus") == RESENT_STATUS) & (F.col("o_orderpriority") == "5-LOW")).alias("again"))


def flow_resent(orders: DataFrame) -> DataFrame:
    day = F.add_months(F.to_date("order_date"), 1)
    return orders.filter("again").withColumns({"amount": (F.col("amount").cast("double") + 1).cast("string"),
                                               "order_date": F.date_format(day, "yyyy-MM-dd")})
