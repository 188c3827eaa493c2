"""The driver's tables seen as retail tables. Every view covers its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(
    spark: SparkSession, sf_dir: str, name: str, key: str, only: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """A text table, dealt out by its key: a file may be one row group, which only one task can read. The partition count is
    given outright: adaptive execution would size the partitions by the texts, and what is made of them is many times larger.
    ``only`` picks rows before they are dealt out."""
    rows = table(spark, sf_dir, name)
    return (only(rows) if only else rows).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), key)


def store_of(col: str | Column) -> Column:
    return F.format_string("STORE_%03d", F.col(col) if isinstance(col, str) else col)


def cashier_of(col: str) -> Column:
    return F.concat(F.lit("CASH_"), (F.col(col) + 1000).cast("string"))


def quantity() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def bronze_events(spark, sf_dir) -> DataFrame:
    """Checkout events as they arrive: text times and a JSON basket."""
    e = table(spark, sf_dir, "events")
    basket = F.concat(
        F.lit('[{"line_seq":1,"item_id":"'), "event_type", F.lit('","quantity":'), F.get_json_object("props", "$.k"), F.lit("}]")
    )
    return e.select(
        F.concat(F.lit("TXN-"), F.col("event_id").cast("string")).alias("transaction_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("event_timestamp"),
        F.lit(None).cast("string").alias("business_date"),
        store_of("user_id").alias("store_id"),
        F.col("value").alias("total_amount_usd"),
        basket.alias("items"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("_ingested_at"),
        F.col("event_id").cast("string").alias("_msk_message_id"),
    )


def inventory(spark, sf_dir) -> DataFrame:
    """A stock baseline for every store and item that occurs in the events."""
    pairs = table(spark, sf_dir, "events").select("user_id", "event_type").distinct()
    size = F.length("event_type")
    return pairs.select(
        store_of("user_id").alias("store_id"),
        F.col("event_type").alias("item_id"),
        (size + 0.5).alias("unit_price_usd"),
        ((F.col("user_id") * 11 + size) % 90).cast("int").alias("opening_qty"),
        ((F.col("user_id") * 7 + size * 3) % 40).cast("int").alias("shelf_qty"),
        ((F.col("user_id") * 5 + size) % 60).cast("int").alias("backroom_qty"),
    )


def stores(spark, sf_dir) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (
        s.join(n, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(r, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            store_of("s_suppkey").alias("store_id"),
            F.col("s_name").alias("store_name"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("region"),
        )
    )


def checkouts(spark, sf_dir) -> DataFrame:
    return as_checkouts(table(spark, sf_dir, "events"))


def as_checkouts(e: DataFrame) -> DataFrame:
    """The events as checkouts at 50 stores: errors are manual overrides, clicks carry a promo code."""
    amount = F.col("value").cast("decimal(18,2)")
    return e.select(
        F.concat(F.lit("TXN-"), F.col("event_id").cast("string")).alias("transaction_id"),
        F.col("ts").cast("timestamp").alias("event_ts"),
        store_of(F.col("user_id") % 50).alias("store_id"),
        cashier_of("user_id").alias("cashier_id"),
        F.col("event_type").alias("payment_method"),
        amount.alias("subtotal_amount"),
        (amount * quantity() / 100).cast("decimal(18,4)").alias("discount_amount"),
        F.when(F.col("event_type") == "click", F.lit("PROMO")).alias("promo_code_applied"),
        (F.col("event_type") == "error").alias("manual_discount_flag"),
    )


def alerts(spark, sf_dir) -> DataFrame:
    """Error and click events as the two kinds of alert."""
    e = table(spark, sf_dir, "events").filter(F.col("event_type").isin("error", "click"))
    anomaly = F.col("event_type") == "error"
    return e.select(
        F.concat(F.when(anomaly, "ALT-ANOMALY-").otherwise("ALT-ABUSE-"), F.col("event_id").cast("string")).alias("alert_id"),
        store_of(F.col("user_id") % 50).alias("store_id"),
        F.when(anomaly, "order_anomaly").otherwise("cashier_promo_abuse").alias("alert_type"),
        F.when(anomaly, "order_anomaly_model").otherwise("cashier_abuse_model").alias("alert_source"),
        F.concat(F.lit("TXN-"), F.col("event_id").cast("string")).alias("transaction_id"),
        cashier_of("user_id").alias("cashier_id"),
        (quantity() / 100).alias("discount_pct"),
        F.round(F.col("value") / (F.col("value") + 100.0), 6).alias("risk_score"),
        F.col("ts").cast("timestamp").alias("alert_ts"),
    )


def order_lines(spark, sf_dir) -> DataFrame:
    """Deduplicated order lines with their order's date and customer."""
    from aislewise.operators.dedup import latest_per_key

    line = latest_per_key(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])
    order = table(spark, sf_dir, "orders")
    return line.join(order, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("l_linenumber").alias("line_seq"),
        F.col("o_custkey").alias("customer_id"),
        F.to_date("o_orderdate").alias("business_date"),
        store_of("l_suppkey").alias("store_id"),
        F.col("l_partkey").alias("item_id"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("extended_price"),
        F.col("l_discount").cast("decimal(6,2)").alias("discount_rate"),
        F.col("l_tax").cast("decimal(6,2)").alias("tax_rate"),
    )


def transactions(spark, sf_dir) -> DataFrame:
    """Gold checkouts: every order with its customer's nation as the store."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    return o.join(c, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("transaction_id"),
        F.to_date("o_orderdate").alias("business_date"),
        store_of("c_nationkey").alias("store_id"),
        F.col("o_orderpriority").alias("payment_method"),
        F.col("o_totalprice").alias("total"),
    )


def gold_checkouts(spark, sf_dir) -> DataFrame:
    """Order totals built from their lines, with the identity total = subtotal - discount + tax."""
    price, cut, tax = F.col("extended_price"), F.col("discount_rate"), F.col("tax_rate")
    per_line = order_lines(spark, sf_dir).select(
        "transaction_id",
        "customer_id",
        "business_date",
        "quantity",
        price.alias("sub"),
        (price * cut).alias("cut"),
        ((price - price * cut) * tax).alias("tax"),
    )
    sums = per_line.groupBy("transaction_id", "customer_id", "business_date").agg(
        F.count(F.lit(1)).alias("item_count"),
        F.sum("quantity").cast("long").alias("total_quantity"),
        F.sum("sub").cast("decimal(38,9)").alias("subtotal_amount"),
        F.sum("cut").cast("decimal(38,9)").alias("discount"),
        F.sum("tax").cast("decimal(38,9)").alias("tax_amount"),
    )
    return sums.withColumn("total", F.col("subtotal_amount") - F.col("discount") + F.col("tax_amount"))


def policies(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_size").cast("long").alias("warranty_duration_months"),
        F.col("p_type").alias("service_level"),
        F.col("p_retailprice").alias("retail_price_usd"),
    )
