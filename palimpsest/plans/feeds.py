"""The benchmark tables read as snapshot feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..spec import SnapshotSpec

# Daily state of a user: the type of the day's last event.
EVENTS = SnapshotSpec(
    key="user_id",
    effective="load_date",
    tracked=("event_type",),
    recency=("ts", "event_id"),
)

# Monthly state of a customer: status and priority of the month's last order.
ORDERS = SnapshotSpec(
    key="o_custkey",
    effective="load_date",
    tracked=("o_orderstatus", "o_orderpriority"),
    recency=("o_orderdate", "o_orderkey"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("load_date", F.to_date("ts"))


def orders_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn(
        "load_date", F.trunc(F.to_date("o_orderdate"), "month")
    )


def registry_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as raw licence records, one snapshot per month, with untidy text.

    Some orders carry a blank or no key, a blank street or building, or a creation date
    that is no ISO date or no real day.
    """
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    joined = (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
    )
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    low, unset = priority == "5-LOW", priority == "4-NOT SPECIFIED"
    open_order, partial = status == "O", status == "P"
    return joined.select(
        F.when(partial & low, "   ")
        .when(partial & unset, F.lit(None))
        .otherwise(F.concat(F.lit(" LIC-"), F.col("o_custkey").cast("string"), F.lit(" ")))
        .alias("license_nbr"),
        F.concat(F.lit("  "), "c_name", F.lit("   "), F.lower("c_mktsegment")).alias(
            "business_name"
        ),
        F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("business_name2"),
        F.when(open_order & low, "").otherwise(F.left(priority, F.lit(1))).alias(
            "address_building"
        ),
        F.when(partial, F.lit(None))
        .when(open_order, "  ")
        .otherwise(F.concat(F.lit(" "), F.replace("n_name", F.lit("_"), F.lit("  "))))
        .alias("address_street"),
        F.lower("r_name").alias("address_city"),
        F.when(unset, " ").otherwise(F.left("r_name", F.lit(2))).alias("address_state"),
        F.col("c_nationkey").cast("string").alias("address_zip"),
        F.concat(status, F.lit("  "), F.lower(status)).alias("license_status"),
        F.lower(priority).alias("license_category"),
        F.when(partial, "2020-13-45")
        .when(open_order, F.date_format("o_orderdate", "MM/dd/yyyy"))
        .otherwise(F.date_format("o_orderdate", " yyyy-MM-dd'T'HH:mm:ss"))
        .alias("license_creation_date"),
        F.trunc(F.to_date("o_orderdate"), "month").alias("load_date"),
        F.col("o_orderdate").alias("ingested_at"),
        F.col("o_orderkey").alias("source_row_number"),
    )

