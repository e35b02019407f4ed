"""Declared schemas of the basket tables and of the feature / training tables.

Column names and order are fixed values that must equal the published feature
table (21 columns) and the serving request (19 features).
"""

from __future__ import annotations

from pyspark.sql import types as T

L, I, D, S = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()


def _st(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


ORDERS = _st(("order_id", L), ("user_id", L), ("eval_set", S), ("order_number", I),
             ("order_dow", I), ("order_hour_of_day", I), ("days_since_prior_order", D))
ORDER_PRODUCTS_PRIOR = _st(("order_id", L), ("product_id", L), ("add_to_cart_order", I),
                           ("reordered", I))
ORDER_PRODUCTS_TRAIN = _st(("order_id", L), ("product_id", L), ("add_to_cart_order", I),
                           ("reordered", I))
PRODUCTS = _st(("product_id", L), ("product_name", S), ("aisle_id", I), ("department_id", I))
AISLES = _st(("aisle_id", I), ("aisle", S))
DEPARTMENTS = _st(("department_id", I), ("department", S))

SOURCE_SCHEMAS = {
    "orders": ORDERS,
    "order_products__prior": ORDER_PRODUCTS_PRIOR,
    "order_products__train": ORDER_PRODUCTS_TRAIN,
    "products": PRODUCTS,
    "aisles": AISLES,
    "departments": DEPARTMENTS,
}

# The 21 feature-table columns in their published order.
FEATURE_COLUMNS = [
    "user_id",
    "product_id",
    "user_product_purchase_count",
    "user_product_reorder_count",
    "user_product_last_order_number",
    "user_product_reorder_rate",
    "user_product_avg_cart_position",
    "user_product_recency_orders",
    "department_id",
    "user_department_purchase_count",
    "user_department_purchase_share",
    "aisle_id",
    "user_aisle_purchase_count",
    "user_aisle_purchase_share",
    "user_total_orders",
    "user_avg_days_between_orders",
    "user_avg_order_hour",
    "user_avg_order_dow",
    "product_total_purchases",
    "product_unique_users",
    "product_reorder_rate",
]

# Warehouse types: INTEGER columns are bigint, FLOAT columns double.
FEATURE_SCHEMA = _st(*[
    (c, D if any(s in c for s in ("rate", "share", "avg")) else L) for c in FEATURE_COLUMNS
])

ID_COLUMNS = ["user_id", "product_id"]
TARGET_COLUMN = "target"
MODEL_FEATURES = [c for c in FEATURE_COLUMNS if c not in ID_COLUMNS]  # 19

# rate/share columns (must lie in [0, 1]) and count columns (>= 0)
# checked by the feature quality report.
RATE_FEATURES = [
    "user_product_reorder_rate",
    "user_department_purchase_share",
    "user_aisle_purchase_share",
    "product_reorder_rate",
]
COUNT_FEATURES = [
    "user_product_purchase_count",
    "user_product_reorder_count",
    "user_product_last_order_number",
    "user_product_avg_cart_position",
    "user_product_recency_orders",
    "user_department_purchase_count",
    "user_aisle_purchase_count",
    "user_total_orders",
    "product_total_purchases",
    "product_unique_users",
]

TRAINING_SCHEMA = T.StructType(FEATURE_SCHEMA.fields + [T.StructField(TARGET_COLUMN, I, True)])
