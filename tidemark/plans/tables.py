"""Table access and the views of the tables that the operators expect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.money import exact_sum, units
from tidemark.operators.report import fold_sales, merge_sales


class Tables:
    """``t.lineitem`` reads ``<folder>/lineitem.parquet``."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def stream_path(self, name: str) -> str:
        """A pattern that a file stream accepts for one file as well as for a folder."""
        return f"{self.folder}/{name}.parquet*"


def sales_lines(lineitem: DataFrame, *keep: str) -> DataFrame:
    """Lines as sales."""
    return lineitem.select(
        *keep,
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("unit_price"),
        F.col("l_discount").alias("discount"),
    )


def sales_by_type(t: Tables) -> DataFrame:
    """Sales totals per part type, folded by part before the join."""
    per_part = fold_sales(sales_lines(t.lineitem, F.col("l_partkey").alias("p_partkey")), "p_partkey")
    return merge_sales(per_part.join(t.part.select("p_partkey", "p_type"), "p_partkey"), "p_type")


def sales_by_region(t: Tables) -> DataFrame:
    """Sales totals per supplier region, folded by supplier before the join."""
    per_supplier = fold_sales(sales_lines(t.lineitem, F.col("l_suppkey").alias("s_suppkey")), "s_suppkey")
    homes = (
        t.supplier.select("s_suppkey", F.col("s_nationkey").alias("n_nationkey"))
        .join(t.nation.select("n_nationkey", F.col("n_regionkey").alias("r_regionkey")), "n_nationkey")
        .join(t.region, "r_regionkey")
        .select("s_suppkey", "r_name")
    )
    return merge_sales(per_supplier.join(homes, "s_suppkey"), "r_name")


def is_error() -> Column:
    return F.col("event_type") == "error"


def priced_events(events: DataFrame) -> DataFrame:
    """Events with their value in whole cents."""
    return events.withColumn("cents", units("value", 2).cast("bigint"))


def raw_sales(t: Tables) -> DataFrame:
    """Lines as an untidy text feed: blank regions and prices, unparsable dates,
    negative prices and huge quantities, each following from the line's own values."""
    price, tax, discount = F.col("l_extendedprice"), F.col("l_tax"), F.col("l_discount")
    return t.lineitem.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("order_id"),
        F.when((F.col("l_linestatus") == "F") & (tax == 0.08), "n/a")
        .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("order_date"),
        F.when(discount == 0.06, "").otherwise(F.col("l_returnflag")).alias("region"),
        F.col("l_linestatus").alias("category"),
        F.when((tax == 0.07) & (discount == 0.1), F.col("l_quantity") * 40)
        .otherwise(F.col("l_quantity")).cast("int").cast("string").alias("quantity"),
        F.when(discount == 0.04, "")
        .when((tax == 0.03) & (discount == 0.02), (-price).cast("string"))
        .otherwise(price.cast("string")).alias("unit_price"),
        discount.cast("string").alias("discount"),
    )


def store_products(part: DataFrame) -> DataFrame:
    """Parts as store products, some with faults."""
    return part.select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.when(F.col("p_brand") == "Brand#7", " ").otherwise(F.col("p_name")).alias("product_name"),
        F.col("p_type").alias("category"),
        F.when((F.col("p_brand") == "Brand#9") & (F.col("p_size") > 25), 0.0)
        .otherwise(F.col("p_retailprice")).alias("price"),
        (F.col("p_size").cast("bigint") - 2).alias("stock"),
        (F.floor(F.col("p_retailprice") / 10) - 90).cast("double").alias("daily_sales"),
        F.length("p_name").cast("bigint").alias("reorder_level"),
        F.when(F.col("p_type") == "PROMO", 1).when(F.col("p_type") == "SMALL", 2).otherwise(90)
        .alias("expiry_days"),
        F.when(F.col("p_type") == "ECONOMY", 700.0).otherwise(F.col("p_retailprice")).alias("last_price"),
    )


def user_records(customer: DataFrame) -> DataFrame:
    """Customers as nested user records, some with faults."""
    balance, name = F.col("c_acctbal"), F.lower(F.replace("c_name", F.lit("#"), F.lit("_")))
    return customer.select(
        F.col("c_custkey").alias("id"),
        name.alias("username"),
        F.when(balance.between(0, 200), F.lit("at sign missing"))
        .when(balance.between(5000, 5200), F.lit(None))
        .otherwise(F.concat(name, F.lit("@example.com"))).alias("email"),
        (F.col("c_nationkey") * 3 - 2).alias("age"),
        (balance > 0).alias("is_active"),
        F.struct(
            F.col("c_mktsegment").alias("country"),
            F.when(balance > 9000, "gold").otherwise("basic").alias("tier"),
            (balance / 95).alias("score"),
        ).alias("profile"),
        F.array_compact(F.array(
            F.lit("all"), F.when(F.col("c_nationkey") > 12, F.lit("north")),
        )).alias("tags"),
    )


def scored_customers(t: Tables) -> DataFrame:
    """Customers with the share of their orders that are not finished as a churn
    probability, 0 without any. Orders are folded per customer before the join."""
    per_customer = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("*").alias("orders"), F.count_if(F.col("o_orderstatus") != "F").alias("open")
    )
    return t.customer.join(per_customer, "c_custkey", "left").select(
        F.col("c_custkey").alias("customer_id"),
        F.coalesce(F.round(F.col("open") / F.col("orders"), 3), F.lit(0.0)).alias("probability"),
        (F.col("c_acctbal") / 97).alias("monthly_charges"),
    )


# Stages of the event journey: task_seq, day, task.
STAGES = ((1, "day1", "view"), (2, "day1", "click"), (3, "day2", "signup"), (4, "day2", "purchase"))
STAGE_EVENTS = 13  # events of a type that finish its stage


def checklist(events: DataFrame) -> DataFrame:
    """Each user's journey as checklist rows, one per stage."""
    per_user = events.groupBy("user_id").agg(
        *[F.count_if(F.col("event_type") == task).alias(task) for _, _, task in STAGES],
        F.count_if(is_error()).alias("errors"),
        F.max("value").alias("largest"),
    )
    rows = F.array(*[
        F.struct(
            F.lit(day).alias("day"), F.lit(seq).alias("task_seq"), F.lit(task).alias("task"),
            (F.col(task) >= STAGE_EVENTS).alias("done"),
        )
        for seq, day, task in STAGES
    ])
    return per_user.select(
        F.col("user_id").alias("learner"),
        F.when(F.col("largest") > 200, "major").otherwise("non-major").alias("track"),
        (F.col("errors") >= 18).alias("help"),
        F.explode(rows).alias("r"),
    ).select("learner", "track", "help", "r.*")


def user_habits(events: DataFrame) -> DataFrame:
    """Per user: whether they buy and click often."""
    return events.groupBy("user_id").agg(
        (F.count_if(F.col("event_type") == "purchase") >= STAGE_EVENTS).alias("buys"),
        (F.count_if(F.col("event_type") == "click") >= STAGE_EVENTS).alias("clicks"),
    )


def churn_customers(t: Tables) -> DataFrame:
    """Customers with features from their orders and whether they stopped ordering."""
    per_customer = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"),
        exact_sum("o_totalprice", 2).alias("spent"),
        F.count_distinct("o_orderpriority").alias("services"),
        F.max("o_orderpriority").alias("payment"), F.min("o_orderstatus").alias("contract"),
    )
    # Customers without orders are kept: no spending, no services, and counted as gone.
    return t.customer.join(per_customer, "c_custkey", "left").select(
        F.format_string("CUST-%05d", "c_custkey").alias("customer_id"),
        F.col("c_mktsegment").alias("gender"),
        (F.col("c_acctbal") > 7000).cast("int").alias("senior"),
        F.coalesce(F.floor(F.months_between(F.lit("2001-08-01").cast("date"), F.col("first").cast("date"))), F.lit(0)).cast("int")
        .alias("tenure_months"),
        F.col("c_acctbal").alias("monthly_charges"),
        F.when(F.col("c_acctbal") >= 0, F.coalesce("spent", F.lit(0.0))).alias("total_charges"),
        F.coalesce("contract", F.lit("none")).alias("contract"),
        F.coalesce("payment", F.lit("none")).alias("payment_method"),
        F.coalesce("services", F.lit(0)).cast("int").alias("num_services"),
        F.coalesce(F.col("last") < F.lit("2001-01-01").cast("timestamp_ntz"), F.lit(True)).cast("int").alias("churn"),
    )
