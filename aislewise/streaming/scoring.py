"""Risk scores, audit status and alert rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aislewise.operators.sales import ALERT_PREFIX, ALERT_SOURCE, ORDER_ANOMALY, PROMO_ABUSE

Scorer = Callable[[DataFrame], Column]
REVIEW_AT = 0.5
MODEL, HEURISTIC = "MODEL_ENDPOINT", "HEURISTIC_CIRCUIT_BREAKER"


def logistic(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def default_cashier_score(df: DataFrame) -> Column:
    """Stand-in for a trained model: rises with overrides, promo share and discount."""
    return logistic(
        F.lit(-3.0)
        + 0.8 * F.col("cashier_1h_manual_override_count")
        + 1.5 * F.col("cashier_1h_promo_rate")
        + 0.01 * F.col("cashier_1h_total_discount_usd")
    )


def default_order_score(df: DataFrame) -> Column:
    return logistic(F.lit(-4.0) + 6.0 * F.col("discount_pct") + 0.005 * F.col("subtotal_amount").cast("double"))


def override_rule() -> Column:
    """More than three overrides and over 50 USD of discount within the hour."""
    return (F.col("cashier_1h_manual_override_count") > 3) & (F.col("cashier_1h_total_discount_usd") > 50.0)


def score_cashiers(metrics: DataFrame, scorer: Scorer | None = default_cashier_score, digits: int = 6) -> DataFrame:
    """Risk, audit status and the path that decided: the model, or the rule where it gave no score."""
    model = F.lit(None).cast("double") if scorer is None else scorer(metrics)
    rule = override_rule().cast("double")
    scored = metrics.withColumn("model_score", F.round(model, digits)).withColumn("heuristic_rule", override_rule())
    return (
        scored.withColumn("risk_score", F.coalesce("model_score", rule))
        .withColumn("detection_mode", F.when(F.col("model_score").isNotNull(), MODEL).otherwise(HEURISTIC))
        .withColumn(
            "audit_status",
            F.when((F.col("risk_score") >= REVIEW_AT) | F.col("heuristic_rule"), "review").otherwise("clear"),
        )
        .drop("model_score")
    )


def alert_id(kind: str, *parts: Column) -> Column:
    """The same source rows always give the same id, so replays do not add alerts. The whole digest is kept."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.concat(F.lit(ALERT_PREFIX[kind]), F.md5(text))


def order_alerts(txn: DataFrame, threshold: float = 0.5, scorer: Scorer = default_order_score) -> DataFrame:
    """Order-level anomalies, one transaction at a time; no state, so it also runs on a stream."""
    share = F.try_divide(F.col("discount_amount").cast("double"), F.col("subtotal_amount").cast("double"))
    priced = txn.withColumn("discount_pct", F.round(share, 4))
    return (
        priced.withColumn("risk_score", F.round(scorer(priced), 6))
        .filter(F.col("risk_score") >= threshold)
        .select(
            alert_id(ORDER_ANOMALY, F.col("transaction_id")).alias("alert_id"),
            "store_id",
            F.lit(ORDER_ANOMALY).alias("alert_type"),
            F.lit(ALERT_SOURCE[ORDER_ANOMALY]).alias("alert_source"),
            "transaction_id",
            "cashier_id",
            "discount_pct",
            "risk_score",
            F.col("event_ts").alias("alert_ts"),
        )
    )


def abuse_alerts(scored: DataFrame, threshold: float = REVIEW_AT) -> DataFrame:
    """Cashier-level alerts from scored windows."""
    return scored.filter((F.col("risk_score") >= threshold) | F.col("heuristic_rule")).select(
        alert_id(PROMO_ABUSE, F.col("store_id"), F.col("cashier_id"), F.unix_micros("last_event_ts")).alias("alert_id"),
        "store_id",
        F.lit(PROMO_ABUSE).alias("alert_type"),
        F.lit(ALERT_SOURCE[PROMO_ABUSE]).alias("alert_source"),
        F.lit(None).cast("string").alias("transaction_id"),
        "cashier_id",
        F.col("cashier_1h_avg_discount_pct").alias("discount_pct"),
        "risk_score",
        F.col("last_event_ts").alias("alert_ts"),
    )
