"""DuckDB SQL for the brute-force oracle: the fixture definitions of
FIXTURES.md §2 and the fact tables, as CTEs. Each registered query appends
its final SELECT. Orderings that Spark resolves with distributed helpers are
written here the plain way (window functions over whole partitions)."""

FIXTURE_CTES = r"""
fx_customers AS (
  SELECT o_orderkey AS customer_id, o_custkey AS customer_unique_id, n_name AS customer_state,
         concat('CITY_', CAST(o_custkey % 40 AS VARCHAR)) AS customer_city,
         CAST(o_custkey % 997 AS VARCHAR) AS zip_raw
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON n_nationkey = CASE WHEN o_orderkey % 200 = 0 THEN (c_nationkey + 1) % 25 ELSE c_nationkey END),
fx_orders AS (
  SELECT o_orderkey AS order_id, o_orderkey AS customer_id,
         CASE WHEN o_orderstatus = 'P' THEN 'canceled' ELSE 'delivered' END AS order_status,
         o_orderdate + INTERVAL '1' HOUR * (o_orderkey % 24) AS order_purchase_timestamp,
         CASE WHEN o_orderkey % 97 <> 0 THEN o_orderdate + INTERVAL '1' HOUR * (o_orderkey % 24 + o_orderkey % 72) END AS order_approved_at,
         CASE WHEN o_orderkey % 499 <> 0 THEN o_orderdate + INTERVAL '1' HOUR *
              (o_orderkey % 24 + 24 * ((7 * o_orderkey + o_custkey) % 40) + o_orderkey % 5) END AS order_delivered_customer_date,
         o_orderdate + INTERVAL '24' DAY AS order_estimated_delivery_date
  FROM orders),
fx_items AS (
  SELECT l_orderkey AS order_id,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate) AS order_item_id,
         l_partkey AS product_id, l_suppkey AS seller_id,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS freight_value
  FROM lineitem),
fx_payments AS (
  SELECT l_orderkey AS order_id, l_linenumber AS payment_sequential, l_returnflag AS payment_type,
         CAST(l_quantity AS INT) AS payment_installments, CAST(l_extendedprice AS DECIMAL(18,2)) AS payment_value
  FROM lineitem),
fx_reviews AS (
  SELECT event_id AS review_id, CAST(floor(event_id * 2 / 3.0) AS BIGINT) AS order_id,
         CASE WHEN event_type <> 'signup' THEN 1 + CAST(floor(value) AS BIGINT) % 5 END AS review_score,
         CASE WHEN event_type IN ('error','view') THEN props END AS review_comment_message,
         ts AS review_creation_date
  FROM events),
fx_products AS (
  SELECT p_partkey AS product_id, CASE WHEN p_partkey % 53 <> 0 THEN lower(p_type) END AS product_category_name,
         CAST(CASE WHEN p_partkey % 17 <> 0 THEN p_size * 100 END AS DOUBLE) AS product_weight_g,
         CAST(p_size AS DOUBLE) AS product_length_cm, CAST(p_size + 1 AS DOUBLE) AS product_height_cm,
         CAST(p_size + 2 AS DOUBLE) AS product_width_cm
  FROM part),
fx_sellers AS (
  SELECT s_suppkey AS seller_id, n_name AS seller_state, concat('CITY_', CAST(s_suppkey % 20 AS VARCHAR)) AS seller_city
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
fx_translation AS (
  SELECT DISTINCT lower(p_type) AS product_category_name,
         CASE WHEN p_type = 'LARGE' THEN 'costruction_large' ELSE concat(lower(p_type), '_goods') END AS product_category_name_english
  FROM part WHERE p_type <> 'SMALL'),
fx_geolocation AS (
  SELECT CAST(c_custkey % 97 AS VARCHAR) AS zip_raw, CAST(CAST(c_acctbal / 1000 AS DECIMAL(9,6)) AS DOUBLE) AS lat,
         CAST(CAST((c_custkey % 360) - 180 AS DECIMAL(9,6)) AS DOUBLE) AS lng,
         concat('CITY_', CAST(c_custkey % 3 AS VARCHAR)) AS city, n_name AS state
  FROM customer JOIN nation ON c_nationkey = n_nationkey)
"""

FACT_CTES = r"""
customers_c AS (
  SELECT customer_id, customer_unique_id, customer_state, customer_city,
         CASE WHEN length(zip_raw) >= 5 THEN zip_raw ELSE lpad(zip_raw, 5, '0') END AS customer_zip_code_prefix
  FROM fx_customers),
products_c AS (
  SELECT p.*, coalesce(CASE WHEN t.product_category_name_english = 'costruction_large' THEN 'construction_large'
                            ELSE t.product_category_name_english END, 'unknown') AS product_category_name_english
  FROM fx_products p LEFT JOIN fx_translation t ON p.product_category_name = t.product_category_name),
items_per_order AS (
  SELECT order_id, sum(price) AS product_sales_value, sum(freight_value) AS freight_value_total,
         count(order_item_id) AS item_count, sum(price) + sum(freight_value) AS order_value
  FROM fx_items GROUP BY order_id),
pay_type AS (
  SELECT order_id, payment_type, count(*) AS n, min(payment_sequential) AS first_seq, sum(payment_value) AS v,
         max(payment_installments) AS inst, count(payment_sequential) AS seqs
  FROM fx_payments GROUP BY order_id, payment_type),
pay_rank AS (
  SELECT order_id, payment_type,
         row_number() OVER (PARTITION BY order_id ORDER BY n DESC, first_seq, payment_type) AS rn
  FROM pay_type WHERE payment_type IS NOT NULL),
payments_agg AS (
  SELECT a.order_id, a.total_payment_value, a.payment_installments, r.payment_type, a.payment_methods_count
  FROM (SELECT order_id, coalesce(sum(v), 0) AS total_payment_value, max(inst) AS payment_installments,
               sum(seqs) AS payment_methods_count FROM pay_type GROUP BY order_id) a
  LEFT JOIN pay_rank r ON r.order_id = a.order_id AND r.rn = 1),
reviews_w AS (
  SELECT order_id,
    last_value(review_id IGNORE NULLS) OVER w AS review_id,
    last_value(review_score IGNORE NULLS) OVER w AS review_score,
    last_value(review_comment_message IGNORE NULLS) OVER w AS review_comment_message,
    last_value(review_creation_date IGNORE NULLS) OVER w AS review_creation_date,
    count(review_id) OVER (PARTITION BY order_id) AS review_event_count
  FROM fx_reviews
  WINDOW w AS (PARTITION BY order_id ORDER BY (review_creation_date IS NULL), review_creation_date, review_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
reviews_agg AS (SELECT DISTINCT * FROM reviews_w),
master_base AS (
  SELECT o.order_id, o.customer_id, o.order_status, o.order_purchase_timestamp, o.order_approved_at,
         o.order_delivered_customer_date, o.order_estimated_delivery_date,
         c.customer_unique_id, c.customer_zip_code_prefix, c.customer_city, c.customer_state,
         i.product_sales_value, i.freight_value_total, i.item_count, i.order_value,
         p.total_payment_value, p.payment_installments, p.payment_type, p.payment_methods_count,
         r.review_score, r.review_event_count, r.review_comment_message, r.review_creation_date,
         CASE WHEN o.order_status = 'delivered' THEN CAST(floor((epoch_us(o.order_delivered_customer_date) - epoch_us(o.order_purchase_timestamp)) / 86400000000.0) AS BIGINT) END AS delivery_days,
         CAST(floor((epoch_us(o.order_estimated_delivery_date) - epoch_us(o.order_purchase_timestamp)) / 86400000000.0) AS BIGINT) AS estimated_days,
         CASE WHEN o.order_status = 'delivered' THEN CAST(floor((epoch_us(o.order_delivered_customer_date) - epoch_us(o.order_estimated_delivery_date)) / 86400000000.0) AS BIGINT) END AS delivery_delay_days
  FROM fx_orders o
  LEFT JOIN customers_c c ON o.customer_id = c.customer_id
  LEFT JOIN items_per_order i ON o.order_id = i.order_id
  LEFT JOIN payments_agg p ON o.order_id = p.order_id
  LEFT JOIN reviews_agg r ON o.order_id = r.order_id),
master AS (
  SELECT *, CASE WHEN delivery_delay_days IS NOT NULL THEN CAST(delivery_delay_days > 0 AS INTEGER) END AS is_late,
         CASE WHEN delivery_delay_days IS NOT NULL THEN 1 - CAST(delivery_delay_days > 0 AS INTEGER) END AS on_time,
         year(order_purchase_timestamp) AS purchase_year, month(order_purchase_timestamp) AS purchase_month,
         strftime(order_purchase_timestamp, '%Y-%m') AS purchase_month_label
  FROM master_base),
delivered AS (SELECT * FROM master WHERE order_status = 'delivered'),
del_valid AS (SELECT * FROM delivered WHERE is_late IS NOT NULL),
item_enrich AS (
  SELECT i.*, p.product_category_name, p.product_category_name_english, p.product_weight_g,
         p.product_length_cm, p.product_height_cm, p.product_width_cm, s.seller_city, s.seller_state,
         i.price + i.freight_value AS item_value,
         p.product_length_cm * p.product_height_cm * p.product_width_cm AS product_volume_cm3
  FROM fx_items i LEFT JOIN products_c p ON i.product_id = p.product_id
  LEFT JOIN fx_sellers s ON i.seller_id = s.seller_id),
full_t AS (
  SELECT m.* EXCLUDE (product_sales_value, freight_value_total, order_value, item_count), ie.* EXCLUDE (order_id)
  FROM master m LEFT JOIN item_enrich ie ON m.order_id = ie.order_id),
first_cat AS (
  SELECT order_id, product_category_name_english, product_category_name FROM (
    SELECT order_id, product_category_name_english, product_category_name,
           row_number() OVER (PARTITION BY order_id ORDER BY order_item_id) AS rn
    FROM full_t WHERE order_status = 'delivered' AND price IS NOT NULL) WHERE rn = 1),
order_sellers AS (
  SELECT DISTINCT order_id, seller_id, seller_state, seller_city
  FROM full_t WHERE order_status = 'delivered' AND seller_id IS NOT NULL)
"""


def with_ctes(final_select: str, extra_ctes: str = "") -> str:
    ctes = FIXTURE_CTES.strip() + ",\n" + FACT_CTES.strip()
    if extra_ctes.strip():
        ctes += ",\n" + extra_ctes.strip()
    return "WITH " + ctes + "\n" + final_select
