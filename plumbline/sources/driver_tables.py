"""The engine's input tables as views over the star-schema and event tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quotes(spark: SparkSession, sf_dir: str, routes: int = 5) -> DataFrame:
    """Every event as a fare quote: the user gives the route, the event the lead window, the event type the carrier."""
    e = F.col("event_id")
    return read(spark, sf_dir, "events").select(
        e.alias("quote_id"),
        F.concat(F.lit("src"), (e % 3).cast("string")).alias("source"),
        F.col("event_type").alias("carrier"),
        (F.col("user_id") % routes).cast("int").alias("route_id"),
        F.to_date("ts").alias("period"),
        F.col("ts").cast("timestamp").alias("collection_ts"),
        F.when(e % 29 == 0, 8).when(e % 4 == 0, 1).when(e % 4 == 1, 7).when(e % 4 == 2, 15).otherwise(30).cast("int").alias("apd"),
        F.col("value").alias("total_fare"),
        F.when(e % 31 == 0, "filed_floor").when(e % 37 == 0, "uncontrolled_lead").when(e % 5 == 0, "economy").alias("fare_class"),
        F.when(e % 41 == 0, "collection_failed").otherwise("observed").alias("observation_status"),
        F.when(e % 43 == 0, "manual").alias("exclusion_reason"),
        F.concat(F.lit("run"), (F.col("user_id") % 50).cast("string"), F.lit("-"), F.date_format("ts", "yyyyMMdd")).alias("run_id"),
    )


def runs(spark: SparkSession, sf_dir: str, sources: int = 250) -> DataFrame:
    """Every event as a collection run of one of the sources; a purchase succeeded, every other signup was partial."""
    e = F.col("event_id")
    return read(spark, sf_dir, "events").select(
        F.concat(F.lit("run"), e.cast("string")).alias("run_id"),
        (F.col("user_id") % sources).cast("int").alias("source"),
        F.col("ts").cast("timestamp").alias("started_at"),
        F.to_date("ts").alias("day"),
        F.when(F.col("event_type") == "purchase", "succeeded").when((F.col("event_type") == "signup") & (e % 2 == 0), "partial").otherwise("failed").alias("status"),
        (e % 47 == 0).alias("selector_relocated"),
        F.when(F.col("event_type") == "error", F.concat(F.lit("error "), F.col("value").cast("string"))).alias("notes"),
        (e % 7 == 0).alias("pending"),
    )


def order_lines(spark: SparkSession, sf_dir: str, value: str, *of_order: Column) -> DataFrame:
    """(s_nation, c_nation, `value` of the line, columns of its order): the order lines with the nation keys of both ends.

    Orders get their customer's nation before the lines meet them, so a line is shuffled once, by its order; suppliers are few and
    hold two numbers each, so Spark broadcasts them while they are small. Names are for the caller to join, after grouping.
    """
    supplier = read(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("s_nation"))
    customer = read(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("c_nation"))
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", *of_order)
    orders = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).drop("o_custkey", "c_custkey")
    line = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", value)
    line = line.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).drop("l_suppkey", "s_suppkey")
    return line.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("l_orderkey", "o_orderkey")


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly directional traffic: goods from the supplier's nation to the customer's, by order month."""
    by = order_lines(spark, sf_dir, "l_quantity", F.trunc("o_orderdate", "MM").alias("period")).groupBy("s_nation", "c_nation", "period").agg(F.sum("l_quantity").alias("q"))
    n = read(spark, sf_dir, "nation")
    ends = [n.select(F.col("n_nationkey").alias(k), F.col("n_name").alias(c)) for k, c in (("s_nation", "city1"), ("c_nation", "city2"))]
    return by.join(ends[0], "s_nation").join(ends[1], "c_nation").groupBy("city1", "city2", "period").agg(F.sum("q").alias("passengers"))


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City name to code; every eleventh nation is refused as a separate airport, every seventh unknown."""
    k = F.col("n_nationkey")
    return read(spark, sf_dir, "nation").select(
        F.col("n_name").alias("city"), F.concat(F.lit("N"), F.lpad(k.cast("string"), 2, "0")).alias("code"), ((k % 11 == 10)).alias("refused"), ((k % 7 == 6) & (k % 11 != 10)).alias("unknown")
    )


def monthly_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(period, stratum, item, price, revenue): unit values of brands within part types by ship month."""
    part = read(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    return (
        read(spark, sf_dir, "lineitem").select("l_partkey", "l_quantity", "l_extendedprice", F.trunc("l_shipdate", "MM").alias("period"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("period", F.col("p_type").alias("stratum"), F.col("p_brand").alias("item"))
        .agg((F.sum("l_extendedprice") / F.sum("l_quantity")).alias("price"), F.sum("l_extendedprice").alias("revenue"))
    )
