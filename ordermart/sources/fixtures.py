"""Bind the driver's TPC-H-like tables to the nine source files.

The pipeline's input is nine delimited text files. The test environment
ships star-schema parquet instead, so each source file is produced as a
deterministic projection of those tables: every column is text, exactly as a
CSV cell would hold it (blank cells are '' here and become NULL on ingest,
like any other null token).

Everything is a lazy DataFrame over the whole driver tables; the only joins
are to ``nation`` / ``region`` and one order-grain join of orders to customer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermart.operators.ranking import row_number_by

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
                 "lineitem", "events")


def read_driver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Two-letter codes of the driver's region names and event types (fixed values).
REGION_STATES = {"AFRICA": "af", "AMERICA": "am", "ASIA": "as", "EUROPE": "eu", "MIDDLE EAST": "mi"}
EVENT_STATES = {"click": "cl", "error": "er", "purchase": "pu", "signup": "si", "view": "vi"}
OTHER_STATE = "xx"


def _s(c: Column) -> Column:
    return c.cast(T.StringType())


def _plus_seconds(ts: Column, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds, ts)


def _ts_text(ts: Column) -> Column:
    return _s(ts.cast(T.TimestampNTZType()))


def _zip5(n: Column) -> Column:
    """Five digits of the key; keys 100,000 apart share a prefix, as people
    share a ZIP."""
    return F.lpad(_s(n % 100000), 5, "0")


def _coded(value: Column, codes: dict[str, str]) -> Column:
    out = F.lit(OTHER_STATE)
    for name, code in codes.items():
        out = F.when(value == name, code).otherwise(out)
    return out


def _geo_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read_driver(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read_driver(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (nation.join(region, nation.n_regionkey == region.r_regionkey)
            .select("n_nationkey", "n_name", "r_name"))


def customers_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One customer row per order; the real person is the TPC-H customer and
    the location drifts over the nations so that 'latest location' matters."""
    o = read_driver(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = read_driver(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    geo = _geo_dims(spark, sf_dir)
    oc = o.join(c, o.o_custkey == c.c_custkey)
    oc = oc.join(geo, geo.n_nationkey == (oc.c_nationkey + oc.o_orderkey % 3) % 25)
    return oc.select(
        F.concat(F.lit("c"), _s(F.col("o_orderkey"))).alias("customer_id"),
        F.concat(F.lit("u"), _s(F.col("o_custkey"))).alias("customer_unique_id"),
        _zip5(F.col("o_custkey")).alias("customer_zip_code_prefix"),
        F.concat(F.lit(" "), F.col("n_name")).alias("customer_city"),
        _coded(F.col("r_name"), REGION_STATES).alias("customer_state"),
    )


def orders_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_driver(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    k = F.col("o_orderkey")
    st = F.col("o_orderstatus")
    ts = F.col("o_orderdate")
    day = F.lit(86400)
    return o.select(
        F.concat(F.lit("o"), _s(k)).alias("order_id"),
        F.concat(F.lit("c"), _s(k)).alias("customer_id"),
        F.when(st == "F", "DELIVERED ").when(st == "O", "Shipped")
        .when(st == "P", "processing").alias("order_status"),
        _ts_text(ts).alias("order_purchase_timestamp"),
        F.when(k % 11 == 0, F.lit(""))
        .otherwise(_ts_text(_plus_seconds(ts, (k % 50) * 600 - 1200))).alias("order_approved_at"),
        F.when(st != "P", _ts_text(_plus_seconds(ts, (k % 5) * day)))
        .alias("order_delivered_carrier_date"),
        F.when((st == "F") & (k % 997 != 0),
               _ts_text(_plus_seconds(ts, (k % 30) * day + (k * 37) % day)))
        .alias("order_delivered_customer_date"),
        _ts_text(_plus_seconds(ts, F.lit(24) * day)).alias("order_estimated_delivery_date"),
    )


def order_items_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item sequence numbers per order. (l_orderkey, l_linenumber) is not
    unique in the driver data, so the number is the line's place in a total
    order of its attributes (``operators.ranking``)."""
    li = read_driver(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        "l_quantity", "l_shipdate", "l_discount", "l_tax", (F.col("l_partkey") % 1000).alias("part_slice"))
    # number the lines on the raw columns first; the text formatting below
    # then runs after the shuffle instead of inflating it
    return item_cells(row_number_by(li, "l_orderkey", ["l_linenumber", "part_slice"], [
        "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate", "l_discount", "l_tax"], "rn"), F.col("rn"))


def item_cells(lines: DataFrame, number: Column) -> DataFrame:
    """The text cells of order lines numbered by ``number``."""
    return lines.select(
        F.concat(F.lit("o"), _s(F.col("l_orderkey"))).alias("order_id"),
        _s(number).alias("order_item_id"),
        F.concat(F.lit("p"), _s(F.col("l_partkey"))).alias("product_id"),
        F.concat(F.lit("s"), _s(F.col("l_suppkey"))).alias("seller_id"),
        _ts_text(F.col("l_shipdate")).alias("shipping_limit_date"),
        _s(F.col("l_extendedprice").cast(T.DecimalType(12, 2))).alias("price"),
        _s(F.col("l_quantity").cast(T.DecimalType(12, 2))).alias("freight_value"),
    )


def order_payments_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One card payment per order; every tenth order splits 60/40 with a
    voucher; orders with key % 1000 = 7 have no payment at all."""
    o = read_driver(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    k = F.col("o_orderkey")
    total = F.col("o_totalprice").cast(T.DecimalType(12, 2))
    first = F.when(k % 10 == 0, (total * F.lit(0.6).cast(T.DecimalType(1, 1))).cast(T.DecimalType(12, 2))) \
        .otherwise(total)

    def row(seq, kind, inst, value):
        return F.struct(F.lit(seq).alias("seq"), F.lit(kind).alias("kind"),
                        inst.alias("inst"), value.alias("value"))

    card = row(1, "CREDIT_CARD", 1 + k % 12, first)
    voucher = row(2, "Voucher ", F.lit(1).cast("bigint"), (total - first).cast(T.DecimalType(12, 2)))
    payments = F.when(k % 10 == 0, F.array(card, voucher)).otherwise(F.array(card))
    exploded = o.filter(k % 1000 != 7).select(k.alias("key"), F.inline(payments))
    return exploded.select(
        F.concat(F.lit("o"), _s(F.col("key"))).alias("order_id"),
        _s(F.col("seq")).alias("payment_sequential"),
        F.col("kind").alias("payment_type"),
        _s(F.col("inst")).alias("payment_installments"),
        _s(F.col("value")).alias("payment_value"),
    )


def order_reviews_csv(spark: SparkSession, sf_dir: str, scores: int = 5) -> DataFrame:
    """One review per event, scored 1 to ``scores``."""
    ev = read_driver(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    e = F.col("event_id")
    target = F.when(e % 7 == 0, e + 1).otherwise(e)
    return ev.select(
        F.concat(F.lit("r"), _s(e)).alias("review_id"),
        F.concat(F.lit("o"), _s(target)).alias("order_id"),
        _s(1 + F.floor(F.col("value")).cast("bigint") % scores).alias("review_score"),
        F.lit("").alias("review_comment_title"),
        F.when(e % 3 == 0, F.concat(F.lit("  "), F.col("event_type")))
        .when(e % 3 == 1, F.lit("")).alias("review_comment_message"),
        _ts_text(F.col("ts")).alias("review_creation_date"),
        _ts_text(_plus_seconds(F.col("ts"), F.lit(172800))).alias("review_answer_timestamp"),
    )


def products_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_driver(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size", "p_retailprice")
    k = F.col("p_partkey")
    return p.select(
        F.concat(F.lit("p"), _s(k)).alias("product_id"),
        F.when(k % 50 == 0, F.lit("")).otherwise(F.lower(F.col("p_type"))).alias("product_category_name"),
        F.concat(_s(F.length("p_name")), F.lit(".0")).alias("product_name_lenght"),
        F.concat(_s(F.col("p_size")), F.lit(".5")).alias("product_description_lenght"),
        F.when(k % 7 == 0, F.lit("")).otherwise(_s(k % 7)).alias("product_photos_qty"),
        _s(F.col("p_retailprice").cast(T.DecimalType(12, 2))).alias("product_weight_g"),
        _s(F.col("p_size")).alias("product_length_cm"),
        F.when(k % 9 == 0, F.lit("")).otherwise(F.lit("12")).alias("product_height_cm"),
        F.lit("10.005").alias("product_width_cm"),
    )


def sellers_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_driver(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    geo = _geo_dims(spark, sf_dir)
    sj = s.join(geo, s.s_nationkey == geo.n_nationkey)
    return sj.select(
        F.concat(F.lit("s"), _s(F.col("s_suppkey"))).alias("seller_id"),
        _zip5(F.col("s_suppkey") * 3).alias("seller_zip_code_prefix"),
        F.concat(F.col("n_name"), F.lit(" ")).alias("seller_city"),
        _coded(F.col("r_name"), REGION_STATES).alias("seller_state"),
    )


def geolocation_csv(spark: SparkSession, sf_dir: str, bad_zip_every: int | None = None) -> DataFrame:
    """One point per event; with ``bad_zip_every`` the users divisible by it have a short ZIP."""
    ev = read_driver(spark, sf_dir, "events").select("user_id", "event_type", "value")
    v = _s(F.col("value").cast(T.DecimalType(12, 2)))
    zip_code = _zip5(F.col("user_id"))
    if bad_zip_every:
        zip_code = F.when(F.col("user_id") % bad_zip_every == 0, "12").otherwise(zip_code)
    return ev.select(
        zip_code.alias("geolocation_zip_code_prefix"),
        F.concat(F.lit("-"), v).alias("geolocation_lat"),
        v.alias("geolocation_lng"),
        F.upper(F.col("event_type")).alias("geolocation_city"),
        _coded(F.col("event_type"), EVENT_STATES).alias("geolocation_state"),
    )


# Category translation binding: one row per distinct part type (lower case)
# except the ones listed as untranslated; the English name is the type with
# a suffix, and the listed blank ones carry '' (so they fall back to the
# original name). With the driver's part types this yields
# economy/economy_line, medium/medium_line, standard/standard_line,
# large/large_line and promo/'' - 'small' has no row.
UNTRANSLATED_TYPES = ("small",)
BLANK_TRANSLATION_TYPES = ("promo",)
TRANSLATION_SUFFIX = "_line"


def translation_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Derived from the part table (a distinct over its types), so the scan
    grows with the data while the vocabulary stays small."""
    t = F.lower(F.col("p_type"))
    types = read_driver(spark, sf_dir, "part").select(t.alias("product_category_name")).distinct()
    name = F.col("product_category_name")
    return types.filter(~name.isin(*UNTRANSLATED_TYPES) & name.isNotNull()).select(
        name,
        F.when(name.isin(*BLANK_TRANSLATION_TYPES), F.lit(""))
        .otherwise(F.concat(name, F.lit(TRANSLATION_SUFFIX))).alias("product_category_name_english"),
    )


SOURCE_BUILDERS = {
    "customers": customers_csv,
    "geolocation": geolocation_csv,
    "order_items": order_items_csv,
    "order_payments": order_payments_csv,
    "order_reviews": order_reviews_csv,
    "orders": orders_csv,
    "products": products_csv,
    "sellers": sellers_csv,
    "product_category_translation": translation_csv,
}


def source_frames(spark: SparkSession, sf_dir: str):
    """The nine source files' contents (text cells), each built on first use."""
    from ordermart.plans.lazy import LazyMap

    return LazyMap({t: (lambda b=build: b(spark, sf_dir)) for t, build in SOURCE_BUILDERS.items()})
