"""Registered queries: profiling, integrity checks and reconciliations."""

from __future__ import annotations

from ..operators import quality as qa
from .contracts import MASTER, parse
from .queries_core import DELAY_BUCKET_SQL
from .queries_customers import RFM_CTE
from .registry import register
from .shared import mart

MASTER_COLS = [n for n, _ in parse(MASTER)]
CHECK_SPEC = "check:s, value:d, expected:d, passed:b"

register("profile_nulls", "table:s, column:s, null_count:i, row_count:i, null_pct:d",
         "\nUNION ALL\n".join(
             f"""SELECT 'orders_master' AS "table", '{c}' AS "column", count(*) FILTER (WHERE "{c}" IS NULL) AS null_count,
                        count(*) AS row_count, count(*) FILTER (WHERE "{c}" IS NULL)::DOUBLE / count(*) * 100 AS null_pct
                 FROM master""" for c in MASTER_COLS))(
    lambda c: qa.profile_nulls(c.master.select(*MASTER_COLS), "orders_master"))

# the nine derived source tables: Spark column -> SQL expression over the fixture CTE
SOURCE_COLUMNS = {
    "customers": ("fx_customers", {"customer_id": "customer_id", "customer_unique_id": "customer_unique_id",
                                   "customer_zip_code_prefix": "zip_raw", "customer_city": "customer_city",
                                   "customer_state": "customer_state"}),
    "orders": ("fx_orders", {c: c for c in ["order_id", "customer_id", "order_status", "order_purchase_timestamp",
                                            "order_approved_at", "order_delivered_customer_date",
                                            "order_estimated_delivery_date"]}),
    "items": ("fx_items", {c: c for c in ["order_id", "order_item_id", "product_id", "seller_id", "price",
                                          "freight_value"]}),
    "payments": ("fx_payments", {c: c for c in ["order_id", "payment_sequential", "payment_type",
                                                "payment_installments", "payment_value"]}),
    "reviews": ("fx_reviews", {c: c for c in ["review_id", "order_id", "review_score", "review_comment_message",
                                              "review_creation_date"]}
                | {c: "CAST(NULL AS VARCHAR)" for c in ["review_comment_title", "review_answer_timestamp"]}),
    "products": ("fx_products", {c: c for c in ["product_id", "product_category_name", "product_weight_g",
                                                "product_length_cm", "product_height_cm", "product_width_cm"]}
                 | {"product_photos_qty": "CAST(NULL AS INT)"}),
    "sellers": ("fx_sellers", {c: c for c in ["seller_id", "seller_city", "seller_state"]}
                | {"seller_zip_code_prefix": "CAST(NULL AS VARCHAR)"}),
    "geolocation": ("fx_geolocation", {"geolocation_zip_code_prefix": "zip_raw", "geolocation_lat": "lat",
                                       "geolocation_lng": "lng", "geolocation_city": "city",
                                       "geolocation_state": "state"}),
    "translation": ("fx_translation", {c: c for c in ["product_category_name", "product_category_name_english"]}),
}


def _null_sql() -> str:
    parts = []
    for t, (cte, cols) in SOURCE_COLUMNS.items():
        for col, expr in cols.items():
            parts.append(f"""SELECT '{t}' AS "table", '{col}' AS "column", count(*) FILTER (WHERE {expr} IS NULL) AS null_count,
                                count(*) AS row_count, count(*) FILTER (WHERE {expr} IS NULL)::DOUBLE / count(*) * 100 AS null_pct
                         FROM {cte}""")
    return "\nUNION ALL\n".join(parts)


register("profile_nulls_sources", "table:s, column:s, null_count:i, row_count:i, null_pct:d", _null_sql())(
    lambda c: qa.union_all([qa.profile_nulls(c.raw[t].select(*cols), t) for t, (_, cols) in SOURCE_COLUMNS.items()]))

register("profile_null_totals", "table:s, null_cells:i, cells:i, null_pct:d",
         f"""SELECT "table", sum(null_count) AS null_cells, sum(row_count) AS cells,
                    sum(null_count)::DOUBLE / sum(row_count) * 100 AS null_pct FROM ({_null_sql()}) GROUP BY 1""")(
    lambda c: qa.null_totals(qa.union_all(
        [qa.profile_nulls(c.raw[t].select(*cols), t) for t, (_, cols) in SOURCE_COLUMNS.items()])))


def _dup_sql() -> str:
    parts = []
    for t, (cte, cols) in SOURCE_COLUMNS.items():
        keys = ", ".join(cols.values())
        parts.append(f"""SELECT '{t}' AS "table", coalesce(sum(n), 0) AS row_count, coalesce(sum(n - 1), 0) AS exact_duplicate_rows
                         FROM (SELECT count(*) AS n FROM {cte} GROUP BY {keys})""")
    return "\nUNION ALL\n".join(parts)


register("profile_exact_duplicates", "table:s, row_count:i, exact_duplicate_rows:i", _dup_sql())(
    lambda c: qa.union_all([qa.profile_exact_duplicates(c.raw[t].select(*cols), t)
                            for t, (_, cols) in SOURCE_COLUMNS.items()]))

REL = [("orders.customer_id -> customers", "fx_orders", "customer_id", "customers_c", "customer_id"),
       ("items.order_id -> orders", "fx_items", "order_id", "fx_orders", "order_id"),
       ("items.product_id -> products", "fx_items", "product_id", "products_c", "product_id"),
       ("items.seller_id -> sellers", "fx_items", "seller_id", "fx_sellers", "seller_id"),
       ("payments.order_id -> orders", "payments_agg", "order_id", "fx_orders", "order_id"),
       ("reviews.order_id -> orders", "reviews_agg", "order_id", "fx_orders", "order_id")]
register("check_referential_integrity", "relation:s, orphans:i, total:i",
         "\nUNION ALL\n".join(
             f"""SELECT '{lab}' AS relation, count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM {p} WHERE {p}.{pc} = c.{cc})) AS orphans,
                        count(*) AS total FROM {ch} c""" for lab, ch, cc, p, pc in REL))(qa.check_referential_integrity)

register("status_counts", "order_status:s, order_count:i",
         "SELECT order_status, count(*) AS order_count FROM fx_orders GROUP BY 1")(lambda c: qa.status_counts(c.orders))

register("category_cardinality", "distinct_categories_pt:i, distinct_categories_en:i, missing_category_pt:i",
         """SELECT count(DISTINCT product_category_name) AS distinct_categories_pt,
                   count(DISTINCT product_category_name_english) AS distinct_categories_en,
                   count(*) FILTER (WHERE product_category_name IS NULL) AS missing_category_pt FROM products_c""")(
    lambda c: qa.category_cardinality(c.products))


def _chk(name: str, value: str, expected: str, tol: float | None = 0.01) -> str:
    passed = f"abs(({value}) - ({expected})) < {tol}" if tol is not None else f"({value}) = ({expected})"
    return (f"SELECT '{name}' AS \"check\", CAST({value} AS DOUBLE) AS value, CAST({expected} AS DOUBLE) AS expected, "
            f"coalesce({passed}, false) AS passed")


STRUCT_SQL = "\nUNION ALL\n".join([
    _chk("master_unique_order_id", "(SELECT count(*) FROM (SELECT order_id FROM master GROUP BY 1 HAVING count(*) > 1))", "0", None),
    _chk("rfm_unique_customer", "(SELECT count(*) FROM (SELECT customer_unique_id FROM rfm GROUP BY 1 HAVING count(*) > 1))", "0", None),
    _chk("master_row_count_preserved", "(SELECT count(*) FROM master)", "(SELECT count(*) FROM fx_orders)", None),
    _chk("full_rows_eq_items_plus_empty_orders", "(SELECT count(*) FROM full_t)",
         "(SELECT count(*) FROM fx_items) + (SELECT count(*) FROM master WHERE order_id NOT IN (SELECT order_id FROM fx_items))", None),
    _chk("delivered_without_delivery_date",
         "(SELECT count(*) FROM fx_orders WHERE order_status = 'delivered' AND order_delivered_customer_date IS NULL)", "0", None),
    _chk("estimated_before_purchase",
         "(SELECT count(*) FROM fx_orders WHERE order_estimated_delivery_date < order_purchase_timestamp)", "0", None),
    _chk("negative_price_items", "(SELECT count(*) FROM fx_items WHERE price < 0)", "0", None),
    _chk("order_value_eq_sales_plus_freight",
         "(SELECT count(*) FROM master WHERE order_value <> product_sales_value + freight_value_total)", "0", None),
    _chk("is_late_only_when_delivered",
         "(SELECT count(*) FROM master WHERE is_late IS NOT NULL AND order_status <> 'delivered')", "0", None),
])
register("structural_checks", CHECK_SPEC, STRUCT_SQL, RFM_CTE)(qa.structural_checks)

_S = "(SELECT sum(product_sales_value) FROM delivered)"
_F = "(SELECT sum(freight_value_total) FROM delivered)"
_N = "(SELECT count(order_id) FROM delivered)"
_OV = "(SELECT sum(order_value) FROM delivered)"
_SI = "(SELECT sum(price) FROM full_t WHERE order_status = 'delivered')"
_MON = "(SELECT sum(monetary) FROM rfm)"
_RC = "(SELECT count(*) FROM rfm)"
_KD = "(SELECT avg(delivery_days) FROM delivered)"
_BK = " ".join(DELAY_BUCKET_SQL.format(x="delivery_delay_days").split())
RECON_SQL = "\nUNION ALL\n".join([
    _chk("kpi_sales_item_vs_order", _SI, _S),
    _chk("kpi_freight_item_vs_order", "(SELECT sum(freight_value) FROM full_t WHERE order_status = 'delivered')", _F),
    _chk("kpi_delivered_orders_item_vs_order",
         "(SELECT count(DISTINCT order_id) FROM full_t WHERE order_status = 'delivered')", _N, None),
    _chk("kpi_aov_recomputed", f"CAST({_OV} AS DOUBLE) / {_N}", f"CAST({_OV} AS DOUBLE) / {_N}"),
    _chk("category_sales_vs_items",
         "(SELECT sum(price) FROM full_t WHERE order_status = 'delivered' AND price IS NOT NULL)", _SI),
    _chk("rfm_monetary_vs_order_value", _MON, _OV),
    _chk("segment_customers_vs_rfm", _RC, _RC, None),
    _chk("segment_revenue_vs_rfm", _MON, _MON),
    _chk("type_customers_vs_rfm", _RC, _RC, None),
    _chk("type_revenue_vs_rfm", _MON, _MON),
    _chk("delivery_on_time_pct_vs_kpi", "(SELECT avg(on_time) * 100 FROM del_valid)",
         "(SELECT avg(on_time) * 100 FROM delivered)", 0.05),
    _chk("delivery_late_pct_vs_kpi", "(SELECT avg(is_late) * 100 FROM del_valid)",
         "(SELECT avg(is_late) * 100 FROM delivered)", 0.05),
    _chk("delivery_avg_days_vs_kpi", "(SELECT avg(delivery_days) FROM del_valid)", _KD, 0.05),
    _chk("delay_bucket_totals_phase5_vs_phase3", "(SELECT count(*) FROM del_valid)",
         "(SELECT count(*) FROM delivered WHERE delivery_days IS NOT NULL)", None),
    _chk("category_order_totals_phase5_vs_phase3", "(SELECT count(*) FROM first_cat)", "(SELECT count(*) FROM first_cat)", None),
    _chk("state_late_pct_phase5_vs_phase3_max_diff",
         "(SELECT coalesce(max(abs(a.l - b.l)), 0) FROM (SELECT customer_state, avg(is_late) * 100 AS l FROM del_valid GROUP BY 1) a "
         "JOIN (SELECT customer_state, avg(is_late) * 100 AS l FROM delivered GROUP BY 1) b ON a.customer_state = b.customer_state)",
         "0", 0.05),
    _chk("bucket_review_phase5_vs_phase3_max_diff",
         "(SELECT coalesce(max(abs(a.s - b.s)), 0) FROM "
         f"(SELECT {_BK} AS k, avg(review_score) AS s FROM del_valid WHERE review_score IS NOT NULL "
         "AND delivery_delay_days IS NOT NULL GROUP BY 1) a JOIN "
         f"(SELECT {_BK} AS k, avg(review_score) AS s FROM delivered WHERE review_score IS NOT NULL "
         "AND delivery_delay_days IS NOT NULL GROUP BY 1) b ON a.k = b.k)", "0", 0.001),
])
register("reconciliations", CHECK_SPEC, RECON_SQL, RFM_CTE)(
    lambda c: qa.reconciliations(c, {k: mart(c, k) for k in (
        "kpis", "cat_perf", "rfm_seg", "repeat", "del_ov", "delay_dist", "buckets", "del_by_cat3", "del_cat",
        "del_state", "del_by_state3", "rev_delay", "rev_vs_delay3")}))
