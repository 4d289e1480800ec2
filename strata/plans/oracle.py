"""DuckDB SQL giving the same rows as each registered query (the
correctness gate). Shared pieces are CTEs composed per query; parameters come
from ``catalog`` and ``feeds`` so both sides always use the same values."""

from __future__ import annotations

from strata.plans import catalog as Q
from strata.plans import feeds as FD

USER_FEED = """user_feed AS (
  SELECT user_id, event_type, ts, event_id, strftime(ts, '%Y-%m-%d') AS batch_key,
         CAST(ts AS DATE) AS event_date
  FROM events)"""

STAGED = """staged_users AS (
  SELECT user_id, batch_key, event_id, event_type, event_date FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, batch_key ORDER BY ts DESC, event_id DESC) AS rn
    FROM user_feed) t
  WHERE rn = 1)"""

USER_FLAGS = """user_flags AS (
  SELECT *, row_number() OVER w AS rn, lag(event_type) OVER w AS prev
  FROM staged_users {where}
  WINDOW w AS (PARTITION BY user_id ORDER BY batch_key, event_date))"""


def user_history(name: str = "user_history", where: str = "") -> str:
    flags = USER_FLAGS.format(where=where).replace("user_flags AS", f"{name}_flags AS", 1)
    return flags + f""",
{name} AS (
  SELECT user_id, event_type, event_date AS valid_from,
         lead(event_date) OVER w AS valid_to,
         lead(event_date) OVER w IS NULL AS is_current
  FROM {name}_flags
  WHERE rn = 1 OR event_type IS DISTINCT FROM prev
  WINDOW w AS (PARTITION BY user_id ORDER BY batch_key, event_date))"""


def _price(batch: int) -> str:
    base = "CAST(p_retailprice AS DECIMAL(12,2))"
    cut = f"CASE WHEN p_size > {FD.CUT_SIZE} THEN {base} - {FD.PRICE_CUT} ELSE {base} END"
    if batch == 0:
        return f"CAST({base} AS DOUBLE)"
    if batch == 1:
        return f"CAST({cut} AS DOUBLE)"
    return f"CAST(CASE WHEN p_size > {FD.RESTORE_SIZE} THEN {base} ELSE {cut} END AS DOUBLE)"


PART_FEED = "part_feed AS (\n" + "\n  UNION ALL\n".join(
    f"  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, '{b}' AS batch_key, "
    f"DATE '{b}-01' AS business_date, {_price(i)} AS price FROM part"
    for i, b in enumerate(FD.PRICE_BATCHES)) + ")"

PART_HISTORY = """part_history AS (
  SELECT product_id, product_name, category, price, business_date AS valid_from,
         lead(business_date) OVER w2 AS valid_to,
         lead(business_date) OVER w2 IS NULL AS is_current
  FROM (
    SELECT *, row_number() OVER w AS rn, lag(product_name) OVER w AS prev_name,
           lag(category) OVER w AS prev_category, lag(price) OVER w AS prev_price
    FROM part_feed
    WINDOW w AS (PARTITION BY product_id ORDER BY batch_key, business_date)) f
  WHERE rn = 1 OR product_name IS DISTINCT FROM prev_name OR category IS DISTINCT FROM prev_category
        OR price IS DISTINCT FROM prev_price
  WINDOW w2 AS (PARTITION BY product_id ORDER BY batch_key, business_date))"""

CUSTOMER_DIM = f"""customer_dim AS (
  SELECT c_custkey AS customer_id, c_name AS name, n_name AS city, c_mktsegment AS segment,
         DATE '{FD.CUSTOMER_BATCHES[0]}-01' AS valid_from,
         CASE WHEN c_mktsegment = '{FD.MOVING_SEGMENT}' THEN DATE '{FD.CUSTOMER_BATCHES[1]}-01' END AS valid_to,
         c_mktsegment <> '{FD.MOVING_SEGMENT}' AS is_current
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  UNION ALL
  SELECT c_custkey, c_name, n_name, c_mktsegment, DATE '{FD.CUSTOMER_BATCHES[1]}-01', NULL, true
  FROM customer JOIN nation ON (c_nationkey + 1) % {FD.NATIONS} = n_nationkey
  WHERE c_mktsegment = '{FD.MOVING_SEGMENT}')"""

ORDERS_RAW = """orders_raw AS (
  SELECT CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 'ord-' || CAST(o_orderkey AS VARCHAR)
              ELSE CAST(o_orderkey AS VARCHAR) END AS order_id,
         CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '4-NOT SPECIFIED' THEN NULL
              ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
         CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '3-MEDIUM' THEN NULL
              WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN CAST(-o_totalprice AS VARCHAR)
              ELSE CAST(o_totalprice AS VARCHAR) END AS amount,
         CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '2-HIGH' THEN strftime(o_orderdate, '%Y-%m') || '-31'
              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS order_date,
         strftime(o_orderdate, '%Y-%m') AS batch_key
  FROM orders
  UNION ALL
  SELECT CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), CAST(o_totalprice + 1 AS VARCHAR),
         strftime(o_orderdate, '%Y-%m-%d'), strftime(o_orderdate + INTERVAL 1 MONTH, '%Y-%m')
  FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '5-LOW'),
orders_typed AS (
  SELECT order_id AS raw_order_id, TRY_CAST(order_id AS BIGINT) AS order_id,
         TRY_CAST(customer_id AS BIGINT) AS customer_id, COALESCE(TRY_CAST(amount AS DOUBLE), 0.0) AS amount,
         CAST(TRY_STRPTIME(order_date, '%Y-%m-%d') AS DATE) AS order_date, batch_key
  FROM orders_raw),
clean_orders AS (
  SELECT order_id, customer_id, amount, order_date, CAST(year(order_date) AS INTEGER) AS year,
         CAST(month(order_date) AS INTEGER) AS month, batch_key
  FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY batch_key DESC) AS rn
        FROM orders_typed WHERE order_id IS NOT NULL AND amount > 0) g
  WHERE rn = 1),
rejects_orders AS (
  SELECT raw_order_id AS order_id, batch_key,
         CASE WHEN order_id IS NULL THEN 'order_id is null or not parseable' ELSE 'amount not > 0' END AS reject_reason
  FROM orders_typed WHERE order_id IS NULL OR NOT (amount > 0))"""

SALES_BY_CITY = f"""sales_by_city AS (
  SELECT city, count(o_orderkey) AS total_orders,
         CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_amount,
         DATE '{FD.AS_OF}' AS update_date
  FROM orders JOIN customer_dim ON o_custkey = customer_id AND is_current
  GROUP BY city)"""

SALES_BY_CATEGORY = f"""sales_by_category AS (
  SELECT p_type AS category, count(l_orderkey) AS total_orders,
         CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_amount,
         count(DISTINCT l_partkey) AS unique_products, DATE '{FD.AS_OF}' AS update_date
  FROM lineitem JOIN part ON l_partkey = p_partkey
  GROUP BY p_type)"""


FLOW_ORDERS = f"""flow_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, product_id, CAST(o_orderdate AS DATE) AS first_date,
    CAST(CASE WHEN again THEN CAST(o_orderdate AS DATE) + INTERVAL 1 MONTH ELSE o_orderdate END AS DATE) AS order_date,
    CAST(o_totalprice AS DECIMAL(18,2)) + CASE WHEN again THEN 1 ELSE 0 END AS amount
  FROM (SELECT *, o_orderstatus = '{FD.RESENT_STATUS}' AND o_orderpriority = '5-LOW' AS again FROM orders)
  LEFT JOIN (SELECT l_orderkey, min(l_partkey) AS product_id FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey)"""


def ranking(n: int, name: str = "ranking") -> str:
    return f"""{name}_spend AS (
  SELECT customer_id, name, city, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_amount
  FROM orders JOIN customer_dim ON o_custkey = customer_id AND is_current
  GROUP BY customer_id, name, city),
{name} AS (
  SELECT * FROM (
    SELECT *, CAST(row_number() OVER (ORDER BY total_amount DESC, customer_id ASC) AS INTEGER) AS ranking
    FROM {name}_spend) r
  WHERE ranking <= {n})"""


JOIN_SIDES = f"""{CUSTOMER_DIM},
{ORDERS_RAW},
dim AS (
  SELECT customer_id, name, city FROM customer_dim WHERE is_current
  UNION ALL
  SELECT -1 - s_suppkey, s_name, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey),
fact AS (SELECT order_id, customer_id, amount FROM clean_orders)"""

USERS = f"{USER_FEED},\n{STAGED}"


def w(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


BROKEN_DOUBLE = (user_history("h_full") + ",\n" + user_history("h_early", f"WHERE batch_key <= '{Q.STALE_DAY}'")
                 + """,
double_loaded AS (SELECT * FROM h_full UNION ALL SELECT * FROM h_early)""")

def _metrics(name: str, source: str, columns: str) -> str:
    counts = [("rows", "count(*)"), *[(f"nulls_{c}", f"count(*) FILTER ({c} IS NULL)") for c in columns.split()]]
    return "\nUNION ALL ".join(f"SELECT '{name}' AS table_name, '{m}' AS metric, {e} AS value FROM {source}" for m, e in counts)


ORACLE: dict[str, str] = {
    "pit_revenue_by_type": w(PART_FEED, PART_HISTORY) + """
SELECT h.category, count(*) AS lines, SUM(l_quantity) AS quantity,
       CAST(SUM(CAST(l_quantity AS DECIMAL(18,2)) * CAST(h.price AS DECIMAL(12,2))) AS DOUBLE) AS revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part_history h
  ON h.product_id = l_partkey AND h.valid_from <= CAST(o_orderdate AS DATE)
 AND (h.valid_to IS NULL OR h.valid_to > CAST(o_orderdate AS DATE))
GROUP BY h.category""",
    "scd2_events_history": w(USERS, user_history()) + "SELECT * FROM user_history",
    "scd2_events_current": w(USERS, user_history()) + "SELECT * FROM user_history WHERE is_current",
    "scd2_events_replay": w(USERS, user_history()) + "SELECT * FROM user_history",
    "scd2_part_price_history": w(PART_FEED, PART_HISTORY) + "SELECT * FROM part_history",
    "scd2_part_price_replay": w(PART_FEED, PART_HISTORY) + "SELECT * FROM part_history",
    "scd1_events": w(USERS) + """SELECT user_id, event_type, event_date AS update_date FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY batch_key DESC, event_date DESC) AS rn
  FROM staged_users) t WHERE rn = 1""",
    "scd1_events_replay": w(USERS) + """SELECT user_id, event_type, event_date AS update_date FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY batch_key DESC, event_date DESC) AS rn
  FROM staged_users) t WHERE rn = 1""",
    "upsert_events": w(USERS) + """SELECT user_id, event_type, event_date AS update_date FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY batch_key DESC, event_date DESC) AS rn
  FROM staged_users) t WHERE rn = 1""",
    "close_changed": w(USERS, user_history("before", f"WHERE batch_key < '{Q.CHANGE_BATCH}'"), f"""changes AS (
  SELECT s.user_id, s.event_date FROM staged_users s
  LEFT JOIN (SELECT user_id, event_type AS cur_type FROM before WHERE is_current) c ON s.user_id = c.user_id
  WHERE s.batch_key = '{Q.CHANGE_BATCH}' AND (c.cur_type IS NULL OR s.event_type IS DISTINCT FROM c.cur_type))""")
    + """SELECT b.user_id, b.event_type, b.valid_from,
       CASE WHEN b.is_current AND c.user_id IS NOT NULL THEN c.event_date ELSE b.valid_to END AS valid_to,
       CASE WHEN b.is_current AND c.user_id IS NOT NULL THEN false ELSE b.is_current END AS is_current
FROM before b LEFT JOIN changes c ON b.user_id = c.user_id""",
    "state_as_of_date": w(USERS, user_history()) + f"""SELECT user_id, event_type, valid_from, valid_to
FROM user_history
WHERE valid_from <= DATE '{Q.AS_OF_DATE}' AND (valid_to > DATE '{Q.AS_OF_DATE}' OR valid_to IS NULL)""",
    "state_as_of_batch": w(USERS, user_history(where=f"WHERE batch_key <= '{Q.AS_OF_BATCH}'"))
    + "SELECT * FROM user_history",
    "batch_change_log": w(USERS, USER_FLAGS.format(where="")) + """SELECT batch_key,
  count(*) FILTER (WHERE rn = 1) AS inserted,
  count(*) FILTER (WHERE rn > 1 AND event_type IS DISTINCT FROM prev) AS updated,
  count(*) FILTER (WHERE rn > 1 AND event_type IS NOT DISTINCT FROM prev) AS unchanged
FROM user_flags GROUP BY batch_key""",
    "discover_batches": r"""WITH files AS (
  SELECT '/landing/events/' || strftime(ts, '%Y-%m') || '/events_' || strftime(ts, '%Y-%m-%d') || '.json' AS f
  FROM events
  UNION ALL
  SELECT '/landing/orders/orders_' || strftime(o_orderdate, '%Y-%m') || '.parquet' FROM orders),
keys AS (SELECT regexp_extract(regexp_extract(f, '[^/]*$', 0), '(\d{4}-\d{2})', 1) AS batch_key FROM files)
SELECT DISTINCT batch_key, CAST(batch_key || '-01' AS DATE) AS business_date
FROM keys WHERE batch_key <> ''""",
    "dedup_latest": w(USERS) + "SELECT * FROM staged_users",
    "clean_orders": w(ORDERS_RAW) + "SELECT * FROM clean_orders",
    "clean_orders_rejects": w(ORDERS_RAW) + "SELECT * FROM rejects_orders",
    "fact_partitioned": w(ORDERS_RAW) + "SELECT * FROM clean_orders",
    "sales_by_city": w(CUSTOMER_DIM, SALES_BY_CITY) + "SELECT * FROM sales_by_city",
    "sales_by_category": w(SALES_BY_CATEGORY) + "SELECT * FROM sales_by_category",
    "customer_ranking": w(CUSTOMER_DIM, ranking(100)) + "SELECT * FROM ranking",
    "customer_top10": w(CUSTOMER_DIM, ranking(10)) + "SELECT * FROM ranking",
    "join_inner": w(JOIN_SIDES) + """SELECT d.customer_id, d.name, d.city, f.order_id, f.amount
FROM dim d JOIN fact f ON d.customer_id = f.customer_id""",
    "join_left": w(JOIN_SIDES) + """SELECT d.customer_id, d.name, d.city, f.order_id, f.amount
FROM dim d LEFT JOIN fact f ON d.customer_id = f.customer_id""",
    "join_right": w(JOIN_SIDES) + """SELECT f.customer_id, d.name, d.city, f.order_id, f.amount
FROM dim d RIGHT JOIN fact f ON d.customer_id = f.customer_id""",
    "join_outer": w(JOIN_SIDES) + """SELECT COALESCE(d.customer_id, f.customer_id) AS customer_id, d.name, d.city,
       f.order_id, f.amount
FROM dim d FULL OUTER JOIN fact f ON d.customer_id = f.customer_id""",
    "join_anti": w(JOIN_SIDES) + """SELECT d.* FROM dim d
WHERE NOT EXISTS (SELECT 1 FROM fact f WHERE f.customer_id = d.customer_id)""",
    "join_semi": w(JOIN_SIDES) + """SELECT d.* FROM dim d
WHERE EXISTS (SELECT 1 FROM fact f WHERE f.customer_id = d.customer_id)""",
    "join_flagged": w(USERS, user_history("before", f"WHERE batch_key < '{Q.CHANGE_BATCH}'"))
    + f"""SELECT s.user_id, s.event_type, d.event_type AS current_event_type, d.valid_from,
       s.event_type IS DISTINCT FROM d.event_type AS is_change
FROM staged_users s JOIN before d ON s.user_id = d.user_id AND d.is_current
WHERE s.batch_key = '{Q.CHANGE_BATCH}'""",
    "union_all": w(USERS, user_history()) + """SELECT user_id, event_type FROM user_history WHERE is_current
UNION ALL SELECT user_id, event_type FROM user_history WHERE NOT is_current""",
    "union_distinct": w(USERS, user_history()) + """SELECT user_id, event_type FROM user_history WHERE is_current
UNION SELECT user_id, event_type FROM user_history WHERE NOT is_current""",
    "union_by_name": w(USERS, user_history()) + """SELECT user_id, event_type FROM user_history WHERE is_current
UNION ALL SELECT user_id, event_type FROM user_history WHERE NOT is_current""",
    "check_row_counts": w(USERS, user_history(), PART_FEED, PART_HISTORY, CUSTOMER_DIM, ORDERS_RAW,
                          SALES_BY_CITY, SALES_BY_CATEGORY, ranking(100)) + """
SELECT 'staged_users' AS table_name, count(*) AS rows FROM staged_users
UNION ALL SELECT 'dim_users_type1', count(DISTINCT user_id) FROM staged_users
UNION ALL SELECT 'dim_users_type2', count(*) FROM user_history
UNION ALL SELECT 'dim_products_type2', count(*) FROM part_history
UNION ALL SELECT 'dim_customers_type2', count(*) FROM customer_dim
UNION ALL SELECT 'fact_orders', count(*) FROM clean_orders
UNION ALL SELECT 'rejects_orders', count(*) FROM rejects_orders
UNION ALL SELECT 'sales_by_city', count(*) FROM sales_by_city
UNION ALL SELECT 'sales_by_category', count(*) FROM sales_by_category
UNION ALL SELECT 'ranking_customers', count(*) FROM ranking""",
    "check_current_versions": w(USERS, BROKEN_DOUBLE, PART_FEED, PART_HISTORY) + """
SELECT 'users_double_loaded' AS dimension, CAST(user_id AS VARCHAR) AS key_value,
       count(*) FILTER (WHERE is_current) AS current_versions
FROM double_loaded GROUP BY user_id HAVING count(*) FILTER (WHERE is_current) <> 1
UNION ALL
SELECT 'products', CAST(product_id AS VARCHAR), count(*) FILTER (WHERE is_current)
FROM part_history GROUP BY product_id HAVING count(*) FILTER (WHERE is_current) <> 1""",
    "check_open_interval": w(USERS, user_history(), PART_FEED, PART_HISTORY, f"""stale AS (
  SELECT user_id, event_type, valid_from, valid_to,
         valid_from <= DATE '{Q.STALE_DAY}' AND (valid_to IS NULL OR valid_to > DATE '{Q.STALE_DAY}') AS is_current
  FROM user_history)""") + """
SELECT 'users_stale_flags' AS dimension, CAST(user_id AS VARCHAR) AS key_value, valid_from, valid_to, is_current
FROM stale WHERE is_current <> (valid_to IS NULL)
UNION ALL
SELECT 'products', CAST(product_id AS VARCHAR), valid_from, valid_to, is_current
FROM part_history WHERE is_current <> (valid_to IS NULL)""",
    "check_orphans": w(ORDERS_RAW, CUSTOMER_DIM, PART_FEED, PART_HISTORY) + """
SELECT 'orphan customer_id' AS issue, f.order_id, CAST(f.customer_id AS VARCHAR) AS missing_key
FROM clean_orders f WHERE NOT EXISTS (SELECT 1 FROM customer_dim d WHERE d.customer_id = f.customer_id)
UNION ALL
SELECT 'orphan product_id', l_orderkey, CAST(l_partkey AS VARCHAR)
FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM part_history p WHERE p.product_id = l_partkey)""",
    "check_intervals": w(USERS, BROKEN_DOUBLE, PART_FEED, PART_HISTORY) + """,
nxt AS (
  SELECT 'users_double_loaded' AS dimension, CAST(user_id AS VARCHAR) AS key_value, valid_from, valid_to,
         lead(valid_from) OVER (PARTITION BY user_id ORDER BY valid_from, valid_to ASC NULLS LAST) AS next_from
  FROM double_loaded
  UNION ALL
  SELECT 'products', CAST(product_id AS VARCHAR), valid_from, valid_to,
         lead(valid_from) OVER (PARTITION BY product_id ORDER BY valid_from, valid_to ASC NULLS LAST)
  FROM part_history),
tagged AS (
  SELECT *, CASE WHEN valid_to < valid_from THEN 'backwards'
                 WHEN next_from IS NOT NULL AND valid_to IS NULL THEN 'open before next'
                 WHEN next_from < valid_to THEN 'overlaps next' END AS issue
  FROM nxt)
SELECT dimension, key_value, valid_from, valid_to, issue FROM tagged WHERE issue IS NOT NULL""",
    "ingest_json": f"""SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, '{FD.CUSTOMER_BATCH}' AS batch_key
FROM customer""",
    "ingest_parquet": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS order_date,
       o_orderpriority, strftime(o_orderdate, '%Y-%m') AS batch_key
FROM orders""",
    "ingest_csv": f"""SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice, '{FD.PRICE_BATCHES[0]}' AS batch_key
FROM part""",
    "ingest_orc": f"""SELECT s_suppkey, s_name, s_nationkey, s_acctbal, '{FD.CUSTOMER_BATCH}' AS batch_key FROM supplier""",
    "ingest_text": f"""SELECT n_nationkey, n_name, n_regionkey, '{FD.CUSTOMER_BATCH}' AS batch_key FROM nation""",
    "ingest_evolution": """SELECT c_custkey, c_name,
       CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN NULL ELSE c_acctbal END AS c_acctbal,
       CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN '1995-01' ELSE '1995-02' END AS batch_key
FROM customer""",
    "ingest_lineage": """SELECT strftime(o_orderdate, '%Y-%m') AS batch_key, count(*) AS rows_ingested,
       min(CAST(o_orderdate AS DATE)) AS first_order_date
FROM orders GROUP BY 1""",
    "masked_customers": w(CUSTOMER_DIM) + "SELECT customer_id, 'XXXX' AS name, city FROM customer_dim WHERE is_current",
    "row_filtered_history": w(USERS, user_history()) + "SELECT * FROM user_history WHERE is_current",
    "compact_orders": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS order_date,
       o_orderpriority FROM orders""",
    "scd2_late_batch": w(USERS, user_history()) + "SELECT * FROM user_history",
    "state_replayed_at_batch": w(USERS, user_history(where=f"WHERE batch_key <= '{Q.AS_OF_BATCH}'")) + "SELECT * FROM user_history",
    "scd2_batch_log": w(USERS, USER_FLAGS.format(where="")) + """, per AS (SELECT batch_key,
    count(*) FILTER (WHERE rn > 1 AND event_type IS DISTINCT FROM prev) AS closed,
    count(*) FILTER (WHERE rn = 1 OR event_type IS DISTINCT FROM prev) AS opened FROM user_flags GROUP BY batch_key)
SELECT batch_key, closed, opened, CAST(SUM(opened - closed) OVER (ORDER BY batch_key) AS BIGINT) AS current FROM per
UNION ALL SELECT '9999-12-31', 0, 0, (SELECT count(DISTINCT user_id) FROM user_feed)""",
    "clean_customers": """WITH raw AS (
  SELECT '0' || c_custkey AS customer_id, CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_name END AS name,
         'nation ' || c_nationkey AS city, CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN '1995-02-31' ELSE '1995-02-01' END AS d,
         CASE WHEN c_mktsegment <> 'FURNITURE' THEN '1995-02' END AS batch_key, c_mktsegment AS seg FROM customer),
reasons AS (SELECT *, CASE WHEN batch_key IS NULL THEN 'batch_key is null or not parseable'
    WHEN name IS NULL THEN 'name is null or not parseable'
    WHEN TRY_STRPTIME(d, '%Y-%m-%d') IS NULL THEN 'event_date is null or not parseable' END AS reject_reason FROM raw)
SELECT CASE WHEN reject_reason IS NULL THEN CAST(CAST(customer_id AS BIGINT) AS VARCHAR) ELSE customer_id END AS customer_id,
  CASE WHEN reject_reason IS NULL THEN name END AS name,
  CASE WHEN reject_reason IS NULL THEN CASE WHEN seg = 'BUILDING' THEN 'MOVED' ELSE city END END AS city,
  CASE WHEN reject_reason IS NULL THEN CASE WHEN seg = 'BUILDING' THEN DATE '1995-02-02' ELSE DATE '1995-02-01' END END AS event_date,
  batch_key, reject_reason FROM reasons""",
    "clean_products": """WITH raw AS (
  SELECT CASE WHEN p_size <> 7 THEN CAST(p_partkey AS VARCHAR) END AS product_id, p_name AS product_name,
    CASE p_size WHEN 3 THEN -1.0 WHEN 4 THEN NULL ELSE p_retailprice END AS price,
    CASE WHEN p_size <> 8 THEN DATE '2026-01-01' END AS launch_date,
    CASE p_size WHEN 5 THEN '2026-13' WHEN 6 THEN NULL ELSE '2026-01' END AS batch_key,
    CASE p_size WHEN 1 THEN 'price not finite or beyond 1e+15' WHEN 2 THEN 'price not finite or beyond 1e+15'
      WHEN 3 THEN 'price not > 0' WHEN 4 THEN 'price not > 0' WHEN 5 THEN 'business_date is null or not parseable'
      WHEN 6 THEN 'batch_key is null or not parseable' WHEN 7 THEN 'product_id is null or not parseable' END AS reject_reason FROM part)
SELECT product_id, CASE WHEN reject_reason IS NULL THEN product_name END AS product_name,
  CASE WHEN reject_reason IS NULL THEN price END AS price, CASE WHEN reject_reason IS NULL THEN launch_date END AS launch_date,
  batch_key, CASE WHEN reject_reason IS NULL THEN DATE '2026-01-01' END AS business_date, reject_reason FROM raw""",
    "ingest_rescued": """SELECT c_custkey, c_name, CASE WHEN early THEN NULL ELSE c_acctbal END AS epoch,
  CASE WHEN early THEN NULL ELSE 'file' END AS their_source_file, CASE WHEN early THEN NULL ELSE c_mktsegment END AS segment,
  CASE WHEN early THEN '1995-01' ELSE '1995-02' END AS batch_key
FROM (SELECT *, c_mktsegment IN ('AUTOMOBILE', 'BUILDING') AS early FROM customer)""",
    "ingest_csv_ragged": """SELECT CASE WHEN p_size BETWEEN 5 AND 40 THEN p_partkey END AS p_partkey,
  CASE WHEN p_size BETWEEN 5 AND 40 THEN p_brand END AS p_brand, CASE WHEN p_size BETWEEN 5 AND 40 THEN p_size END AS p_size,
  CASE WHEN p_size > 40 THEN p_partkey || ',' || p_brand || ',' || p_size || ',more'
       WHEN p_size < 5 THEN p_partkey || ',' || p_brand END AS broken_line FROM part""",
    "ingest_files": """SELECT 'batch_key=' || strftime(o_orderdate, '%Y-%m') AS directory, count(*) AS rows_ingested
FROM orders GROUP BY 1""",
    "history_sorted": w(USERS, user_history()) + """SELECT *, row_number() OVER (ORDER BY user_id, valid_from) AS position
FROM user_history""",
    "sales_sorted": w(SALES_BY_CATEGORY) + """SELECT *, row_number() OVER (ORDER BY total_amount DESC, category) AS position
FROM sales_by_category""",
    "orders_limit": """SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS amount FROM orders
ORDER BY o_totalprice DESC, o_orderkey LIMIT 25""",
    "sql_functions": w(CUSTOMER_DIM) + "SELECT customer_id, 'XXXX' AS name, city FROM customer_dim WHERE is_current",
    "fact_refreshed": w(ORDERS_RAW) + f"""SELECT order_id, customer_id, CASE WHEN year = {Q.REFRESH_YEAR} THEN amount + 1 ELSE amount END AS amount,
  order_date, year, month, batch_key FROM clean_orders""",
    "ingest_variant": """SELECT c_custkey AS customer_id, c_name AS name, CASE WHEN early THEN 'none' END AS unnamed,
  CASE WHEN early THEN round(c_acctbal) WHEN c_mktsegment <> 'MACHINERY' THEN c_acctbal END AS balance,
  CASE WHEN c_mktsegment = 'MACHINERY' THEN 'balance' ELSE '' END AS unfit, NOT early AS upper_keys,
  CASE WHEN early THEN '1995-01' ELSE '1995-02' END AS batch_key
FROM (SELECT *, c_mktsegment IN ('AUTOMOBILE', 'BUILDING') AS early FROM customer)""",
    "ingest_csv_options": f"""SELECT p_partkey, p_name, p_brand, 'a;b' || chr(39) || p_size AS note, seen,
  CAST(seen + INTERVAL {Q.RETENTION_DAYS} DAY AS DATE) AS expires
FROM (SELECT *, CAST(DATE '{Q.RETENTION_START}' + p_size::INT AS DATE) AS seen FROM part)
WHERE seen + INTERVAL {Q.RETENTION_DAYS} DAY >= DATE '{Q.RETENTION_END}' OR day(seen) <= 10""",
    "write_metrics": w(ORDERS_RAW, CUSTOMER_DIM) + _metrics("fact_orders", "clean_orders", "order_id customer_id amount order_date year month batch_key")
    + " UNION ALL " + _metrics("rejects_orders", "rejects_orders", "order_id batch_key reject_reason")
    + " UNION ALL " + _metrics("dim_customers", "customer_dim", "customer_id name city segment valid_from valid_to is_current"),
    "schema_report": """SELECT table_name, column_name, status, was, declared,
  CASE status WHEN 'added' THEN 0 WHEN 'extra' THEN NULL ELSE CASE WHEN column_name = 'update_date' THEN n - b ELSE n END END AS filled
FROM (VALUES
  ('fact_orders', 'order_id', 'widened', 'int', 'bigint'), ('fact_orders', 'customer_id', 'conflict', 'string', 'bigint'),
  ('fact_orders', 'product_id', 'added', NULL, 'string'), ('fact_orders', 'amount', 'conflict', 'string', 'double'),
  ('fact_orders', 'order_date', 'same', 'date', 'date'), ('fact_orders', 'batch_key', 'added', NULL, 'string'),
  ('fact_orders', 'year', 'same', 'int', 'int'), ('fact_orders', 'month', 'same', 'int', 'int'),
  ('fact_orders', 'o_orderpriority', 'extra', 'string', NULL),
  ('dim_customers_type1', 'customer_id', 'widened', 'int', 'bigint'), ('dim_customers_type1', 'name', 'same', 'string', 'string'),
  ('dim_customers_type1', 'city', 'added', NULL, 'string'), ('dim_customers_type1', 'update_date', 'conflict', 'string', 'date')
) t(table_name, column_name, status, was, declared)
JOIN (SELECT 'fact_orders' AS table_name, count(*) AS n, 0 AS b FROM orders
      UNION ALL SELECT 'dim_customers_type1', count(*), count(*) FILTER (c_mktsegment = 'BUILDING') FROM customer) USING (table_name)""",
    "upsert_buckets": w(USERS) + f"""SELECT user_id, max_by(event_type, batch_key) AS event_type, max_by(event_date, batch_key) AS update_date,
  count(DISTINCT part) - 1 AS n_updates FROM (
  SELECT *, CASE WHEN batch_key <= '{Q.UPSERT_SPLIT}' THEN 0 WHEN day_number <= days // 2 THEN 1 ELSE 2 END AS part FROM staged_users
  LEFT JOIN (SELECT batch_key, row_number() OVER (ORDER BY batch_key) AS day_number, count(*) OVER () AS days
             FROM (SELECT DISTINCT batch_key FROM staged_users WHERE batch_key > '{Q.UPSERT_SPLIT}')) USING (batch_key))
GROUP BY user_id""",
    "fingerprint_changes": w(USERS, user_history()) + """SELECT batch_key, opened, closed, sum(opened - closed) OVER (ORDER BY batch_key)::BIGINT AS current
FROM (SELECT batch_key, (SELECT count(*) FROM user_history h WHERE h.valid_from = CAST(b.batch_key AS DATE)) AS opened,
        (SELECT count(*) FROM user_history h WHERE h.valid_to = CAST(b.batch_key AS DATE)) AS closed
      FROM (SELECT DISTINCT batch_key FROM staged_users) b)""",
    "net_changes": w(USERS, user_history()) + f"""SELECT coalesce(a.user_id, b.user_id) AS user_id, CASE WHEN a.user_id IS NULL THEN 'insert' ELSE 'update' END AS change,
  a.event_type AS old_event_type, b.event_type AS new_event_type, a.valid_from AS old_valid_from, b.valid_from AS new_valid_from
FROM (SELECT * FROM user_history WHERE valid_from <= DATE '{Q.AS_OF_BATCH}' AND coalesce(valid_to > DATE '{Q.AS_OF_BATCH}', true)) a
FULL JOIN (SELECT * FROM user_history WHERE valid_from <= DATE '{Q.CHANGE_BATCH}' AND coalesce(valid_to > DATE '{Q.CHANGE_BATCH}', true)) b
  ON a.user_id = b.user_id WHERE a.event_type IS DISTINCT FROM b.event_type""",
    "stream_history": w(USERS, user_history()) + "SELECT * FROM user_history",
    "join_bucketed": w(JOIN_SIDES) + """SELECT f.customer_id, d.name, d.city, f.order_id, f.amount
FROM dim d JOIN fact f ON d.customer_id = f.customer_id""",
    "ingest_manifest": f"""SELECT strftime(o_orderdate, '%Y-%m') AS batch_key, count(*) AS rows_ingested,
  CASE WHEN min(year(o_orderdate)) < {Q.DROP_YEARS[0]} THEN 0 WHEN min(year(o_orderdate)) < {Q.DROP_YEARS[1]} THEN 1 ELSE 2 END AS epoch,
  0 AS rows_without_file, 0 AS files_twice FROM orders GROUP BY 1""",
    "ingest_mixed_case": """SELECT c_custkey AS customer_id, c_name AS name, CASE WHEN early THEN c_mktsegment END AS segment,
  CASE WHEN NOT early THEN c_acctbal END AS balance, CASE WHEN NOT early THEN NULLIF(-c_custkey, c_custkey) END AS other_spelling,
  CASE WHEN early THEN '1995-01' ELSE '1995-02' END AS batch_key
FROM (SELECT *, c_mktsegment IN ('AUTOMOBILE', 'BUILDING') AS early FROM customer)""",
    "incremental_recovered": w(FLOW_ORDERS) + f"""SELECT p_type AS category, count(*) AS total_orders, CAST(SUM(amount) AS DOUBLE) AS total_amount,
  count(DISTINCT p_partkey) AS unique_products, DATE '{FD.AS_OF}' AS update_date
FROM flow_orders JOIN part ON product_id = p_partkey GROUP BY p_type""",
    "sales_refreshed": w(CUSTOMER_DIM, FLOW_ORDERS) + f"""SELECT city, count(*) AS total_orders, CAST(SUM(amount) AS DOUBLE) AS total_amount,
  DATE '{FD.AS_OF}' AS update_date
FROM flow_orders JOIN customer_dim ON flow_orders.customer_id = customer_dim.customer_id AND is_current
WHERE NOT ({Q.EMPTIED[0] * 100 + Q.EMPTIED[1]} IN (year(first_date) * 100 + month(first_date), year(order_date) * 100 + month(order_date)))
GROUP BY city""",
    "compact_partitioned": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS order_date,
       o_orderpriority FROM orders""",
}
