"""Dashboard queries of the SQL course (AG7, AG8), a preview and a file inventory, over the TPC-H style tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelet.functions.timefns import parse_timestamp
from lakelet.session import new_run_dir
from lakelet.sources.tables import file_inventory, preview, read_path, read_path_sql, sf_table


def part_supply(lineitem: DataFrame) -> DataFrame:
    """AG7: total quantity per part, named as in the course's first query."""
    return lineitem.groupBy(F.col("l_partkey").alias("ps_partkey")).agg(
        F.sum("l_quantity").alias("total_availqty")
    )


def price_by_priority(orders: DataFrame) -> DataFrame:
    """AG8: total order price per month and priority (the stacked-bar data), in the prices' own type."""
    return orders.groupBy(
        F.trunc(F.col("o_orderdate").cast("date"), "month").alias("order_month"),
        F.col("o_orderpriority").alias("priority"),
    ).agg(F.sum("o_totalprice").alias("total_price"))


def q_part_supply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_supply(sf_table(spark, sf_dir, "lineitem"))


def q_price_by_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    # sums of doubles differ in their last digits with the order of rows: two digits for comparison
    return price_by_priority(sf_table(spark, sf_dir, "orders")).withColumn("total_price", F.round("total_price", 2))


def q_orders_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SC2, SK14, DT9, MA1, PR4: what a notebook shows of the orders read by their path in SQL: a renamed key,
    a time from text (every tenth text is no time), whole prices."""
    orders = read_path_sql(spark, f"{sf_dir.rstrip('/')}/orders.parquet").withColumnRenamed("o_orderkey", "order_key")
    text = F.when(F.col("order_key") % 10 == 0, "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    shown = orders.select("order_key", parse_timestamp(text).alias("placed_at"), F.round("o_totalprice", 0).alias("total_price"), "o_orderstatus")
    return preview(shown.orderBy("order_key"))


def q_order_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SC12: the inventory of a table written by month, held against the files that its rows are read from:
    per month the rows, and whether the inventory names exactly their files, none of them empty."""
    path = f"{new_run_dir(spark, 'order-files')}/orders"
    orders = sf_table(spark, sf_dir, "orders")
    orders.withColumn("order_month", F.date_format("o_orderdate", "yyyy-MM")).repartition("order_month").write.partitionBy("order_month").parquet(path)
    month = F.regexp_extract("path", "order_month=([^/]+)/", 1)
    name = F.regexp_extract("path", "([^/]+)$", 1)
    files = file_inventory(spark, path).select(month.alias("order_month"), name.alias("file"), "length")
    rows = read_path(spark, path).groupBy(F.col("order_month").cast("string").alias("order_month"), F.col("_metadata.file_name").alias("file")).agg(F.count("*").alias("n"))
    both = files.join(rows, ["order_month", "file"], "full")
    return both.groupBy("order_month").agg(F.sum("n").alias("n_rows"), F.bool_and(F.col("n").isNotNull() & (F.coalesce("length", F.lit(0)) > 0)).alias("all_listed"))


ORACLE = {
    "order_files": "SELECT strftime(o_orderdate, '%Y-%m') AS order_month, count(*) AS n_rows, true AS all_listed FROM orders GROUP BY 1",
    "orders_preview": """SELECT o_orderkey AS order_key, CASE WHEN o_orderkey % 10 <> 0 THEN date_trunc('second', o_orderdate) END AS placed_at,
       round(o_totalprice, 0) AS total_price, o_orderstatus
FROM orders ORDER BY o_orderkey LIMIT 1000""",
    "part_supply": """SELECT l_partkey AS ps_partkey, sum(l_quantity) AS total_availqty
FROM lineitem GROUP BY l_partkey""",
    "price_by_priority": """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS order_month,
       o_orderpriority AS priority,
       round(sum(o_totalprice), 2) AS total_price
FROM orders GROUP BY 1, 2""",
}
