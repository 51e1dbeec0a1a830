"""Staging models: typed, trimmed, one row per source row (geolocation: one
per ZIP prefix). Every model is a projection over one raw table, except
products (a left join to the category translation) and geolocation (a
group-by)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermart.functions import (
    blank_to_null,
    text_to_decimal,
    text_to_int_rounded,
    text_to_int_strict,
    text_to_timestamp,
)
from ordermart.schemas import COORD, MONEY, UNKNOWN_CATEGORY


def _t(name: str):
    return F.trim(F.col(name))


def _audit(df: DataFrame, staged_at) -> list:
    return [F.col("loaded_at").alias("source_loaded_at"), F.lit(staged_at).alias("staged_at")]


def stg_customers(raw: DataFrame, staged_at) -> DataFrame:
    return raw.select(
        _t("customer_id").alias("customer_id"),
        _t("customer_unique_id").alias("customer_unique_id"),
        _t("customer_zip_code_prefix").alias("customer_zip_code_prefix"),
        F.lower(_t("customer_city")).alias("customer_city"),
        F.upper(_t("customer_state")).alias("customer_state"),
        *_audit(raw, staged_at),
    )


def stg_products(raw: DataFrame, translation: DataFrame, staged_at) -> DataFrame:
    """Untrimmed category joins the translation; a NULL category never matches.
    The translation is a category vocabulary (tens of rows), so Spark's
    size-checked auto-broadcast picks it; nothing forces a broadcast."""
    t = translation.select(
        F.col("product_category_name").alias("t_name"),
        F.col("product_category_name_english").alias("t_english"),
    )
    p = raw.join(t, raw.product_category_name == t.t_name, "left")
    original = blank_to_null(_t("product_category_name"))
    return p.select(
        _t("product_id").alias("product_id"),
        original.alias("product_category_name_original"),
        F.coalesce(blank_to_null(F.trim(F.col("t_english"))), original,
                   F.lit(UNKNOWN_CATEGORY)).alias("product_category_name"),
        text_to_int_rounded(blank_to_null(F.col("product_name_lenght"))).alias("product_name_length"),
        text_to_int_rounded(blank_to_null(F.col("product_description_lenght"))).alias("product_description_length"),
        text_to_int_rounded(blank_to_null(F.col("product_photos_qty"))).alias("product_photos_qty"),
        text_to_decimal(blank_to_null(F.col("product_weight_g")), MONEY).alias("product_weight_g"),
        text_to_decimal(blank_to_null(F.col("product_length_cm")), MONEY).alias("product_length_cm"),
        text_to_decimal(blank_to_null(F.col("product_height_cm")), MONEY).alias("product_height_cm"),
        text_to_decimal(blank_to_null(F.col("product_width_cm")), MONEY).alias("product_width_cm"),
        *_audit(raw, staged_at),
    )


def stg_sellers(raw: DataFrame, staged_at) -> DataFrame:
    return raw.select(
        _t("seller_id").alias("seller_id"),
        _t("seller_zip_code_prefix").alias("seller_zip_code_prefix"),
        F.lower(_t("seller_city")).alias("seller_city"),
        F.upper(_t("seller_state")).alias("seller_state"),
        *_audit(raw, staged_at),
    )


NO_ZIP = "\0"


def stg_geolocation(raw: DataFrame, staged_at) -> DataFrame:
    """One representative row per ZIP prefix: mean coordinates, modal city and
    state (NULLs ignored, ties to the smallest value)."""
    g = raw.select(
        # a missing ZIP is a group too; a joinable stand-in, as joins pass over NULL
        F.coalesce(_t("geolocation_zip_code_prefix"), F.lit(NO_ZIP)).alias("zip"),
        F.col("geolocation_lat").cast("decimal(28,18)").alias("lat"),
        F.col("geolocation_lng").cast("decimal(28,18)").alias("lng"),
        F.lower(_t("geolocation_city")).alias("city"),
        F.upper(_t("geolocation_state")).alias("state"),
        F.col("loaded_at"),
    )
    # one pass: each ZIP, its cities and its states as grouping sets, so a hot ZIP is combined map side and dealt by value
    sets = g.groupingSets([["zip"], ["zip", "city"], ["zip", "state"]], "zip", "city", "state").agg(
        F.grouping_id().alias("set"), F.count(F.lit(1)).alias("n"),
        # inputs already carry 18 fractional digits: avg is (32,22), exact enough
        F.avg("lat").cast(COORD).alias("lat"), F.avg("lng").cast(COORD).alias("lng"), F.max("loaded_at").alias("loaded_at"))
    # the bits of a set tell the columns left out: city is 2, state is 1
    whole, by_city, by_state = (F.col("set") == k for k in (3, 1, 2))

    def most_frequent(of, value):
        """The value most often seen, the smallest of equally frequent ones, NULLs aside."""
        return F.min(F.when(of & F.col(value).isNotNull(), F.struct((-F.col("n")).alias("n"), value)))[value].alias(value)

    out = sets.groupBy("zip").agg(
        F.max(F.when(whole, F.col("lat"))).alias("geolocation_lat"), F.max(F.when(whole, F.col("lng"))).alias("geolocation_lng"),
        F.max("loaded_at").alias("source_loaded_at"), most_frequent(by_city, "city"), most_frequent(by_state, "state"))
    return out.select(
        F.nullif(F.col("zip"), F.lit(NO_ZIP)).alias("geolocation_zip_code_prefix"),
        "geolocation_lat", "geolocation_lng", F.col("city").alias("geolocation_city"), F.col("state").alias("geolocation_state"),
        "source_loaded_at", F.lit(staged_at).alias("staged_at"),
    )


def stg_orders(raw: DataFrame, staged_at) -> DataFrame:
    return raw.select(
        _t("order_id").alias("order_id"),
        _t("customer_id").alias("customer_id"),
        F.lower(_t("order_status")).alias("order_status"),
        text_to_timestamp(F.col("order_purchase_timestamp")).alias("order_purchase_timestamp"),
        text_to_timestamp(blank_to_null(F.col("order_approved_at"))).alias("order_approved_at"),
        text_to_timestamp(blank_to_null(F.col("order_delivered_carrier_date"))).alias("order_delivered_carrier_date"),
        text_to_timestamp(blank_to_null(F.col("order_delivered_customer_date"))).alias("order_delivered_customer_date"),
        text_to_timestamp(F.col("order_estimated_delivery_date")).alias("order_estimated_delivery_date"),
        *_audit(raw, staged_at),
    )


def stg_order_items(raw: DataFrame, staged_at) -> DataFrame:
    return raw.select(
        _t("order_id").alias("order_id"),
        text_to_int_strict(F.col("order_item_id")).alias("order_item_id"),
        _t("product_id").alias("product_id"),
        _t("seller_id").alias("seller_id"),
        text_to_timestamp(F.col("shipping_limit_date")).alias("shipping_limit_date"),
        text_to_decimal(F.col("price"), MONEY).alias("price"),
        text_to_decimal(F.col("freight_value"), MONEY).alias("freight_value"),
        *_audit(raw, staged_at),
    )


def stg_order_payments(raw: DataFrame, staged_at) -> DataFrame:
    return raw.select(
        _t("order_id").alias("order_id"),
        text_to_int_strict(F.col("payment_sequential")).alias("payment_sequential"),
        F.lower(_t("payment_type")).alias("payment_type"),
        text_to_int_strict(F.col("payment_installments")).alias("payment_installments"),
        text_to_decimal(F.col("payment_value"), MONEY).alias("payment_value"),
        *_audit(raw, staged_at),
    )


def stg_order_reviews(raw: DataFrame, staged_at) -> DataFrame:
    return raw.select(
        _t("review_id").alias("review_id"),
        _t("order_id").alias("order_id"),
        text_to_int_strict(F.col("review_score")).alias("review_score"),
        blank_to_null(_t("review_comment_title")).alias("review_comment_title"),
        blank_to_null(_t("review_comment_message")).alias("review_comment_message"),
        text_to_timestamp(F.col("review_creation_date")).alias("review_creation_date"),
        text_to_timestamp(F.col("review_answer_timestamp")).alias("review_answer_timestamp"),
        *_audit(raw, staged_at),
    )


def build_staging(raw, staged_at):
    """Staging models over a raw-table mapping, each built on first use."""
    from ordermart.plans.lazy import LazyMap

    return LazyMap({
        "customers": lambda: stg_customers(raw["customers"], staged_at),
        "products": lambda: stg_products(raw["products"], raw["product_category_translation"], staged_at),
        "sellers": lambda: stg_sellers(raw["sellers"], staged_at),
        "geolocation": lambda: stg_geolocation(raw["geolocation"], staged_at),
        "orders": lambda: stg_orders(raw["orders"], staged_at),
        "order_items": lambda: stg_order_items(raw["order_items"], staged_at),
        "order_payments": lambda: stg_order_payments(raw["order_payments"], staged_at),
        "order_reviews": lambda: stg_order_reviews(raw["order_reviews"], staged_at),
    })
