"""Flight records made from the shipment tables, so that every cleaning rule has work to do."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The order in which rows arrived; unique.
ARRIVAL_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def flights_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per shipment: ship date as flight date, days since the order as arrival delay."""
    nation = table(spark, sf_dir, "nation")
    origins = nation.select(F.col("n_nationkey").alias("from_key"), F.lower("n_name").alias("origin"))
    destinations = nation.select(
        F.col("n_nationkey").alias("to_key"), F.lower("n_name").alias("to_nation")
    )
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    quantity = F.col("l_quantity").cast("int")
    # Few and narrow columns, and customers joined to orders before the shipments are, so that shipments, the largest
    # table, move once for their orders and once for their parts.
    placed = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "o_orderdate", "c_nationkey"
    )
    lines = table(spark, sf_dir, "lineitem").select(
        *ARRIVAL_ORDER,
        "l_shipdate",
        quantity.alias("quantity"),
        F.when(F.col("l_discount") != 0.0, (quantity - 20).cast("double")).alias("dep_delay"),
        F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"), 1).otherwise(0).alias("cancelled"),
    )
    shipped = (
        lines.join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(origins, F.col("s_nationkey") == F.col("from_key"))
        .join(destinations, F.col("c_nationkey") == F.col("to_key"))
    )
    return shipped.select(
        F.year("l_shipdate").alias("Year"),
        F.month("l_shipdate").alias("Month"),
        F.dayofmonth("l_shipdate").alias("DayofMonth"),
        F.col("p_brand").alias("carrier"),
        F.col("l_suppkey").cast("string").alias("flight_num"),
        "origin",
        F.when(F.col("l_linenumber") != 6, F.col("to_nation")).alias("dest"),
        F.when(F.col("l_linenumber") != 7, F.col("quantity") * 50).alias("dep_time"),
        "dep_delay",
        F.datediff("l_shipdate", "o_orderdate").cast("double").alias("arr_delay"),
        "cancelled",
        *ARRIVAL_ORDER,
    )
