"""Output contracts of the registered queries: column names and kinds.

Both the Spark result and the SQL oracle are projected through the same
contract, so names, order and types line up: ``s`` string, ``i`` bigint,
``d`` double rounded to 6 decimals (decimal money is summed exactly first),
``t`` timestamp, ``b`` boolean.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def parse(spec: str) -> list[tuple[str, str]]:
    out = []
    for part in spec.split(","):
        part = part.strip()
        if part:
            name, kind = part.split(":")
            out.append((name.strip(), kind.strip()))
    return out


def spark_project(df: DataFrame, spec: str) -> DataFrame:
    cols = []
    for name, kind in parse(spec):
        c = F.col(name)
        if kind == "s":
            c = c.cast("string")
        elif kind == "i":
            c = c.cast("bigint")
        elif kind == "d":
            c = F.round(c.cast("double"), 6)
        elif kind == "b":
            c = c.cast("boolean")
        cols.append(c.alias(name))
    return df.select(*cols)


def sql_project(inner: str, spec: str) -> str:
    exprs = []
    for name, kind in parse(spec):
        q = f'q."{name}"'
        if kind == "s":
            e = f"CAST({q} AS VARCHAR)"
        elif kind == "i":
            e = f"CAST({q} AS BIGINT)"
        elif kind == "d":
            e = f"round(CAST({q} AS DOUBLE), 6)"
        elif kind == "b":
            e = f"CAST({q} AS BOOLEAN)"
        else:
            e = q
        exprs.append(f'{e} AS "{name}"')
    return f"SELECT {', '.join(exprs)} FROM (\n{inner}\n) q"


MASTER = ("order_id:i, customer_id:i, order_status:s, order_purchase_timestamp:t, order_approved_at:t, "
          "order_delivered_customer_date:t, order_estimated_delivery_date:t, customer_unique_id:i, "
          "customer_zip_code_prefix:s, customer_city:s, customer_state:s, product_sales_value:d, "
          "freight_value_total:d, item_count:i, order_value:d, total_payment_value:d, payment_installments:i, "
          "payment_type:s, payment_methods_count:i, review_score:i, review_event_count:i, "
          "review_comment_message:s, review_creation_date:t, delivery_days:i, estimated_days:i, "
          "delivery_delay_days:i, is_late:i, on_time:i, purchase_year:i, purchase_month:i, purchase_month_label:s")
