"""Inputs of the four programs, derived by Spark from the driver's tables.

The reference ships no data, so each input is a projection (and, for nested
orders, a grouping) of the generated TPC-H-style tables.  Every function is lazy
and scales with its source tables.  Mapping rules (documented in FIXTURES.md):

* taxi trips      <- events:   pickup zip = user_id, drop-off zip = k of props,
                               drop-off time = ts + (5 + k) minutes, fare = value,
                               distance = k / 10
* sales orders    <- orders + customer + lineitem: one JSON object per order with
                               an ``ordered_products`` array; pending orders
                               (status 'P') carry no order number yet; every
                               tenth order under a name no customer has
* customers       <- customer + nation + region, every field as text
* recordings      <- events:   mrn = user_id, device = event_id,
                               heartrate = value - 20, time = epoch seconds;
                               every tenth of a patient nobody knows
* patients        <- customer: mrn = c_custkey, name = c_name
* user pings      <- events:   user = user_id as text, ping = floor(value), time = ts
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelet.functions.timefns import ntz_epoch_micros
from lakelet.sources.tables import sf_table

# Fixed values of the fixture mapping.
DROPOFF_BASE_MINUTES = 5
HEARTRATE_SHIFT = 20.0
PENDING_STATUS = "P"
MISS_EVERY = 10
UNKNOWN_PATIENT = 1_000_000_000


def _k(props: str = "props"):
    return F.get_json_object(F.col(props), "$.k").cast("int")


def taxi_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = sf_table(spark, sf_dir, "events")
    k = _k()
    return ev.select(
        F.col("user_id").alias("pickup_zip"),
        k.alias("dropoff_zip"),
        F.col("ts").alias("tpep_pickup_datetime"),
        F.timestamp_add("MINUTE", k + F.lit(DROPOFF_BASE_MINUTES), F.col("ts")).alias("tpep_dropoff_datetime"),
        F.col("value").alias("fare_amount"),
        (k / F.lit(10.0)).alias("trip_distance"),
    )


def sales_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with its line items nested as an array of structs.

    Line items are grouped per order key; an order holds a handful of items, so
    the grouping is bounded per key.  Orders without items get an empty array.
    """
    orders = sf_table(spark, sf_dir, "orders")
    cust = sf_table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    items = (
        sf_table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.collect_list(
                F.struct(
                    F.col("l_returnflag").alias("curr"),
                    F.col("l_partkey").alias("id"),
                    F.col("l_extendedprice").alias("price"),
                    F.col("l_quantity").alias("qty"),
                )
            ).alias("ordered_products")
        )
    )
    o = orders.join(cust, orders.o_custkey == cust.c_custkey, "left").join(
        items, orders.o_orderkey == items.l_orderkey, "left"
    )
    products = F.coalesce(F.col("ordered_products"), F.array().cast(items.schema["ordered_products"].dataType))
    return o.select(
        F.col("o_custkey").alias("customer_id"),
        # every tenth order came in under another name: the left join finds no customer for it
        F.when(F.col("o_orderkey") % MISS_EVERY == 0, F.concat("c_name", F.lit(" (moved)"))).otherwise(F.col("c_name")).alias("customer_name"),
        F.size(products).alias("number_of_line_items"),
        F.unix_timestamp("o_orderdate").cast("string").alias("order_datetime"),
        F.when(F.col("o_orderstatus") != F.lit(PENDING_STATUS), F.col("o_orderkey")).alias("order_number"),
        products.alias("ordered_products"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = sf_table(spark, sf_dir, "customer")
    n = sf_table(spark, sf_dir, "nation")
    r = sf_table(spark, sf_dir, "region")
    j = c.join(n, c.c_nationkey == n.n_nationkey, "left").join(r, F.col("n_regionkey") == r.r_regionkey, "left")
    return j.select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("r_name").alias("state"),
        F.col("n_name").alias("city"),
        F.lit(None).cast("string").alias("lon"),
        F.lit(None).cast("string").alias("lat"),
        F.lit(None).cast("string").alias("units_purchased"),
        F.col("c_mktsegment").alias("loyalty_segment"),
    )


def recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = sf_table(spark, sf_dir, "events")
    us = ntz_epoch_micros(F.col("ts"))
    return ev.select(
        F.col("event_id").cast("string").alias("device_id"),
        # every tenth recording is of nobody known: the inner join drops it
        (F.col("user_id") + F.when(F.col("event_id") % MISS_EVERY == 0, UNKNOWN_PATIENT).otherwise(0)).cast("string").alias("mrn"),
        (F.col("value") - F.lit(HEARTRATE_SHIFT)).cast("string").alias("heartrate"),
        (us / F.lit(1_000_000.0)).alias("time"),
    )


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = sf_table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("mrn"), F.col("c_name").alias("name"))


def user_pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = sf_table(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").cast("string").alias("user_id"),
        F.floor("value").cast("int").alias("ping"),
        F.col("ts").alias("time"),
    )
