"""Declared schemas, accepted values and check names.

Everything in the FIXED VALUES block must stay exactly as written: these are
the source-file contract, the null tokens a delimited reader maps to NULL,
the accepted order statuses, the key patterns and the published check names.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the upstream contract; natural order, unchanged)
# ---------------------------------------------------------------------------

# Source catalogue: CSV file name -> (raw table, ordered header columns).
SOURCE_FILES: dict[str, tuple[str, tuple[str, ...]]] = {
    "olist_customers_dataset.csv": (
        "customers",
        ("customer_id", "customer_unique_id", "customer_zip_code_prefix",
         "customer_city", "customer_state"),
    ),
    "olist_geolocation_dataset.csv": (
        "geolocation",
        ("geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng",
         "geolocation_city", "geolocation_state"),
    ),
    "olist_order_items_dataset.csv": (
        "order_items",
        ("order_id", "order_item_id", "product_id", "seller_id",
         "shipping_limit_date", "price", "freight_value"),
    ),
    "olist_order_payments_dataset.csv": (
        "order_payments",
        ("order_id", "payment_sequential", "payment_type",
         "payment_installments", "payment_value"),
    ),
    "olist_order_reviews_dataset.csv": (
        "order_reviews",
        ("review_id", "order_id", "review_score", "review_comment_title",
         "review_comment_message", "review_creation_date",
         "review_answer_timestamp"),
    ),
    "olist_orders_dataset.csv": (
        "orders",
        ("order_id", "customer_id", "order_status", "order_purchase_timestamp",
         "order_approved_at", "order_delivered_carrier_date",
         "order_delivered_customer_date", "order_estimated_delivery_date"),
    ),
    "olist_products_dataset.csv": (
        "products",
        ("product_id", "product_category_name", "product_name_lenght",
         "product_description_lenght", "product_photos_qty", "product_weight_g",
         "product_length_cm", "product_height_cm", "product_width_cm"),
    ),
    "olist_sellers_dataset.csv": (
        "sellers",
        ("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"),
    ),
    "product_category_name_translation.csv": (
        "product_category_translation",
        ("product_category_name", "product_category_name_english"),
    ),
}

# Default NA strings of the pandas CSV reader (plus the blank field).
NULL_TOKENS: tuple[str, ...] = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

ORDER_STATUSES: tuple[str, ...] = (
    "approved", "canceled", "created", "delivered",
    "invoiced", "processing", "shipped", "unavailable",
)

# Java regex: `\z` is the true end of input (`$` would accept a trailing newline).
ZIP_PATTERN = r"^[0-9]{5}\z"
STATE_PATTERN = r"^[A-Z]{2}\z"

UNKNOWN_CATEGORY = "unknown"

STAGING_CHECK_NAMES: tuple[str, ...] = (
    "customer raw/staging row counts match",
    "order raw/staging row counts match",
    "order item raw/staging row counts match",
    "payment raw/staging row counts match",
    "review raw/staging row counts match",
    "product raw/staging row counts match",
    "seller raw/staging row counts match",
    "customer IDs are not null",
    "order IDs are not null",
    "customer IDs are unique",
    "order IDs are unique",
    "orders have customers",
    "order items have orders",
    "order items have products",
    "order items have sellers",
    "payments have orders",
    "reviews have orders",
    "review scores are between 1 and 5",
    "item prices and freight are nonnegative",
    "payment values are nonnegative",
    "product measurements are nonnegative",
    "products use unknown category",
    "customer ZIP prefixes lack geolocation",
    "seller ZIP prefixes lack geolocation",
    "orders have no payment record",
    "delivered orders lack customer delivery timestamp",
    "order approval occurs before purchase",
    "customer delivery occurs before purchase",
)

ANALYTICS_CHECK_NAMES: tuple[str, ...] = (
    "customer dimension has one row per unique customer",
    "product dimension matches staging products",
    "seller dimension matches staging sellers",
    "order fact matches staging orders",
    "order item fact matches staging items",
    "fact order item counts reconcile",
    "fact payment total reconciles to staging",
    "fact product value reconciles to staging",
    "fact freight value reconciles to staging",
    "order item total equals price plus freight",
    "analytics monetary values are nonnegative",
    "late-delivery flag is present for delivered orders with dates",
    "monthly order counts reconcile to delivered orders",
    "monthly revenue reconciles to delivered revenue",
    "state order counts reconcile to delivered orders",
    "category item counts reconcile to order item facts",
    "seller item counts reconcile to order item facts",
    "dashboard late rate is between zero and one",
    "dashboard average review is between one and five",
)

# Keys profiled in the raw tables: label, table, columns.
RAW_KEYS = (
    ("customers.customer_id", "customers", ("customer_id",)),
    ("orders.order_id", "orders", ("order_id",)),
    ("order_items.(order_id, order_item_id)", "order_items", ("order_id", "order_item_id")),
    ("order_payments.(order_id, payment_sequential)", "order_payments", ("order_id", "payment_sequential")),
    ("order_reviews.(review_id, order_id)", "order_reviews", ("review_id", "order_id")),
    ("products.product_id", "products", ("product_id",)),
    ("sellers.seller_id", "sellers", ("seller_id",)),
    ("translation.product_category_name", "product_category_translation", ("product_category_name",)),
)

# Declared constraints of each table: primary key, NOT NULL columns, foreign
# keys (column, parent table, parent column).
STAGING_AUDIT = ("source_loaded_at", "staged_at")
TABLE_KEYS = {
    "staging.customers": (("customer_id",),
                          ("customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state", *STAGING_AUDIT),
                          ()),
    "staging.products": (("product_id",), ("product_category_name", *STAGING_AUDIT), ()),
    "staging.sellers": (("seller_id",), ("seller_zip_code_prefix", "seller_city", "seller_state", *STAGING_AUDIT), ()),
    "staging.geolocation": (("geolocation_zip_code_prefix",),
                            ("geolocation_lat", "geolocation_lng", "geolocation_city", "geolocation_state", *STAGING_AUDIT),
                            ()),
    "staging.orders": (("order_id",),
                       ("customer_id", "order_status", "order_purchase_timestamp", "order_estimated_delivery_date",
                        *STAGING_AUDIT),
                       (("customer_id", "staging.customers", "customer_id"),)),
    "staging.order_items": (("order_id", "order_item_id"),
                            ("product_id", "seller_id", "shipping_limit_date", "price", "freight_value", *STAGING_AUDIT),
                            (("order_id", "staging.orders", "order_id"), ("product_id", "staging.products", "product_id"),
                             ("seller_id", "staging.sellers", "seller_id"))),
    "staging.order_payments": (("order_id", "payment_sequential"),
                               ("payment_type", "payment_installments", "payment_value", *STAGING_AUDIT),
                               (("order_id", "staging.orders", "order_id"),)),
    "staging.order_reviews": (("review_id", "order_id"),
                              ("review_score", "review_creation_date", "review_answer_timestamp", *STAGING_AUDIT),
                              (("order_id", "staging.orders", "order_id"),)),
    "analytics.dim_customers": (("customer_unique_id",),
                                ("latest_zip_code_prefix", "latest_city", "latest_state", "first_order_at", "last_order_at",
                                 "lifetime_order_count", "created_at"), ()),
    "analytics.dim_products": (("product_id",), ("product_category_name", "created_at"), ()),
    "analytics.dim_sellers": (("seller_id",), ("seller_zip_code_prefix", "seller_city", "seller_state", "created_at"), ()),
    "analytics.fact_orders": (("order_id",),
                              ("customer_unique_id", "customer_state", "order_status", "order_purchase_timestamp",
                               "order_estimated_delivery_date", "item_count", "product_value", "freight_value",
                               "payment_value", "created_at"),
                              (("customer_unique_id", "analytics.dim_customers", "customer_unique_id"),)),
    "analytics.fact_order_items": (("order_id", "order_item_id"),
                                   ("product_id", "seller_id", "shipping_limit_date", "price", "freight_value",
                                    "item_total_value", "created_at"),
                                   (("order_id", "analytics.fact_orders", "order_id"),
                                    ("product_id", "analytics.dim_products", "product_id"),
                                    ("seller_id", "analytics.dim_sellers", "seller_id"))),
}

# ---------------------------------------------------------------------------
# Derived structures
# ---------------------------------------------------------------------------

RAW_TABLES: tuple[str, ...] = tuple(t for t, _ in SOURCE_FILES.values())
RAW_COLUMNS: dict[str, tuple[str, ...]] = {t: cols for t, cols in SOURCE_FILES.values()}
RAW_FILE_OF: dict[str, str] = {t: f for f, (t, _) in SOURCE_FILES.items()}


def raw_text_schema(table: str) -> T.StructType:
    """All-text schema of a raw source file (no inference: ZIP zeros survive)."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS[table]])


MONEY = T.DecimalType(12, 2)
MONEY_TOTAL = T.DecimalType(14, 2)
MONEY_REPORT = T.DecimalType(16, 2)
REVIEW_AVG = T.DecimalType(3, 2)
RATE = T.DecimalType(7, 4)
DAYS = T.DecimalType(10, 2)
COORD = T.DecimalType(10, 7)
