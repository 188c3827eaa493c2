"""Sales KPIs, cashier rates, offender audits, stock availability and retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aislewise.functions.numbers import money_sum, percent, ratio
from aislewise.functions.time import within_days
from aislewise.operators.dedup import latest_per_key, top_per_key

# Alert types, their models and the prefixes of their ids.
ORDER_ANOMALY, PROMO_ABUSE = "order_anomaly", "cashier_promo_abuse"
ALERT_SOURCE = {ORDER_ANOMALY: "order_anomaly_model", PROMO_ABUSE: "cashier_abuse_model"}
ALERT_PREFIX = {ORDER_ANOMALY: "ALT-ANOMALY-", PROMO_ABUSE: "ALT-ABUSE-"}


def as_timestamp(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def store_day_kpis(txn: DataFrame, amount: str = "total") -> DataFrame:
    """Gross revenue, checkouts and mean basket per store and day."""
    gross = F.round(money_sum(F.col(amount)), 2).cast("double")
    return txn.groupBy("business_date", "store_id").agg(
        gross.alias("gross_revenue_usd"),
        F.count(F.lit(1)).alias("txn_count"),
        ratio(gross, F.count(F.lit(1))).alias("avg_basket_usd"),
    )


def intraday_sales(txn: DataFrame, as_of_date: str) -> DataFrame:
    """One business day only; on a table partitioned by ``business_date`` nothing else is read."""
    return txn.filter(F.col("business_date") == F.lit(as_of_date).cast("date"))


def payment_breakdown(txn: DataFrame, amount: str = "total") -> DataFrame:
    """Checkouts, revenue and share of revenue per payment method."""
    per_method = txn.groupBy("payment_method").agg(
        F.count(F.lit(1)).alias("txn_count"), money_sum(F.col(amount)).alias("revenue")
    )
    total = per_method.agg(F.sum("revenue")).scalar()
    return per_method.select(
        "payment_method",
        "txn_count",
        F.round("revenue", 2).cast("double").alias("revenue_usd"),
        percent(ratio(F.col("revenue"), total)).alias("revenue_share_pct"),
    )


def promo_alert_rate(alerts: DataFrame) -> DataFrame:
    """Share of a store's alerts, per day, that are promo abuse, as a percentage."""
    return alerts.groupBy("store_id", F.to_date("alert_ts").alias("alert_date")).agg(
        F.count(F.lit(1)).alias("alerts"),
        percent(ratio(F.count_if(F.col("alert_type") == PROMO_ABUSE), F.count(F.lit(1)))).alias("promo_override_rate_pct"),
    )


def override_rates(txn: DataFrame, as_of: Column, short: int = 7, long: int = 30) -> DataFrame:
    """Both trailing windows in one aggregation: the short one is a condition inside the long one."""
    recent = txn.filter(within_days(F.col("event_ts"), as_of, long) & (F.col("event_ts") <= as_of))
    in_short = within_days(F.col("event_ts"), as_of, short)
    flag = F.col("manual_discount_flag")
    return recent.groupBy("cashier_id").agg(
        F.count_if(in_short).alias(f"txn_count_{short}d"),
        F.count(F.lit(1)).alias(f"txn_count_{long}d"),
        percent(ratio(F.count_if(in_short & flag), F.count_if(in_short))).alias(f"override_rate_{short}d_pct"),
        percent(ratio(F.count_if(flag), F.count(F.lit(1)))).alias(f"override_rate_{long}d_pct"),
    )


def live_against_baseline(txn: DataFrame, as_of: Column, live_hours: int = 1, days: int = 30) -> DataFrame:
    """Each live cashier's override rate next to the trailing baseline, with ratio and difference.

    The live hours lie inside the baseline's days, so one scan and one aggregation give both.
    """
    recent = txn.filter(within_days(F.col("event_ts"), as_of, days) & (F.col("event_ts") <= as_of))
    live = F.col("event_ts") > as_of - F.expr(f"INTERVAL {int(live_hours)} HOURS")
    flag = F.col("manual_discount_flag")
    n_live, n_live_overrides = F.count_if(live), F.count_if(live & flag)
    rates = recent.groupBy("cashier_id").agg(
        n_live.alias("live_txn_count"),
        n_live_overrides.alias("live_override_count"),
        percent(ratio(n_live_overrides, n_live)).alias("live_override_rate_pct"),
        percent(ratio(F.count_if(flag), F.count(F.lit(1)))).alias("baseline_rate_pct"),
    )
    return rates.filter(F.col("live_txn_count") > 0).select(
        "*",
        F.round(F.try_divide("live_override_rate_pct", "baseline_rate_pct"), 2).alias("times_baseline"),
        F.round(F.col("live_override_rate_pct") - F.col("baseline_rate_pct"), 2).alias("difference_pct"),
    )


def offender_ranking(alerts: DataFrame, as_of: Column, days: int = 7, top: int | None = 20) -> DataFrame:
    """Cashiers by promo-abuse alerts in the trailing days, most first."""
    ranked = (
        alerts.filter((F.col("alert_type") == PROMO_ABUSE) & within_days(F.col("alert_ts"), as_of, days))
        .groupBy("store_id", "cashier_id")
        .agg(
            F.count("alert_id").alias("alert_count"),
            F.round(money_sum(F.col("risk_score")).cast("double") / F.count("risk_score"), 4).alias("avg_risk_score"),
            F.max("risk_score").alias("max_risk_score"),
            F.max("alert_ts").alias("latest_alert_ts"),
        )
        .orderBy(F.desc("alert_count"), F.desc("avg_risk_score"), "store_id", "cashier_id")
    )
    return ranked if top is None else ranked.limit(top)


def cashier_log(txn: DataFrame, cashier_id: str | Column, top: int = 10) -> DataFrame:
    """One cashier's checkouts, oldest first."""
    return (
        txn.filter(F.col("cashier_id") == (F.lit(cashier_id) if isinstance(cashier_id, str) else cashier_id))
        .orderBy("event_ts", "transaction_id")
        .limit(top)
    )


def top_offender_log(alerts: DataFrame, txn: DataFrame, as_of: Column, days: int = 7, top: int = 10) -> DataFrame:
    """Rank the offenders, then read the log of the first; the id never leaves the cluster."""
    worst = offender_ranking(alerts, as_of, days, top=1).select("cashier_id").scalar()
    return cashier_log(txn, worst, top)


def newest_alerts_per_store(alerts: DataFrame, as_of: Column, hours: int = 24, top: int = 10) -> DataFrame:
    recent = alerts.filter(
        (F.col("alert_ts") > as_of - F.expr(f"INTERVAL {int(hours)} HOURS")) & (F.col("alert_ts") <= as_of)
    )
    return top_per_key(recent, ["store_id"], [F.desc("alert_ts"), "alert_id"], top)


def available_to_promise(updates: DataFrame) -> DataFrame:
    """Latest stock reading per store and item, with reservations taken off."""
    latest = latest_per_key(updates, ["store_id", "item_id"], ["updated_at"])
    return latest.withColumn("atp_qty", F.col("on_hand_qty") - F.col("reserved_qty"))


def compact(df: DataFrame, keys: list[str], ts: str, as_of: Column, max_age_days: int, versions: int | None = 1) -> DataFrame:
    """Retention: rows inside the age limit, and of each key only the newest version if asked."""
    fresh = df.filter(within_days(F.col(ts), as_of, max_age_days))
    if versions is None:
        return fresh
    if versions == 1:
        return latest_per_key(fresh, keys, [ts])
    order = [F.desc(ts), *[F.desc(c) for c in sorted(df.columns) if c not in [*keys, ts]]]
    return top_per_key(fresh, keys, order, versions, "version")


# Retention in days by table, and by family of the serving table.
RETENTION_DAYS = {
    "historical_transactional_data": 730,
    "pos_transactions_streaming": 90,
    "cashier_abuse_alerts": 30,
    "realtime": 7,
    "hourly_metrics": 30,
    "inventory": 14,
}
