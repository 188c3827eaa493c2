"""Business terms: a formula, the table it belongs to, and the rows it counts."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aislewise.functions.numbers import money, money_sum, ratio
from aislewise.functions.time import month_boundaries
from aislewise.operators.sales import PROMO_ABUSE


def net_revenue() -> Column:
    return money(F.col("subtotal_amount")) - money(F.col("discount")) + money(F.col("tax_amount"))


def on_hand_units() -> Column:
    return F.col("shelf_qty") + F.col("backroom_qty")


def trading_cover_hours(units: str = "total_units_sold_intraday") -> Column:
    """Cover over a twelve-hour trading day; the ledger's own cover spreads sales over 24 hours."""
    return ratio(on_hand_units(), F.col(units) / 12.0)


def cover_risk(hours: Column) -> Column:
    return F.when(hours <= 6.0, "CRITICAL_BURN_SPIKE").when(hours <= 12.0, "MONITOR_VELOCITY")


def shelf_stock_pct() -> Column:
    return ratio(F.col("shelf_qty"), on_hand_units()) * 100.0


def under_warranty(as_of: Column, purchased: Column) -> Column:
    return month_boundaries(as_of, purchased) <= F.col("warranty_duration_months")


@dataclass(frozen=True)
class Term:
    name: str
    category: str
    table: str
    total: Column
    rows: Column | None = None


def glossary() -> tuple[Term, ...]:
    """Terms as table-level totals. Built on call: columns need a live session."""
    return (
        Term("net-transaction-revenue", "store-ops", "pos_transactions_gold", money_sum(net_revenue()), F.col("total") > 0),
        Term("total-on-hand-inventory", "inventory-mgmt", "gold_inventory_reconciliation_ledger", F.sum(on_hand_units())),
        Term(
            "inventory-cover-hours",
            "inventory-mgmt",
            "gold_inventory_reconciliation_ledger",
            ratio(F.sum(on_hand_units()), F.sum("total_units_sold_intraday") / 12.0),
        ),
        Term(
            "cashier-override-rate",
            "loss-prevention",
            "pos_anomaly_alerts",
            ratio(F.count_if(F.col("alert_type") == PROMO_ABUSE), F.count(F.lit(1))),
        ),
        Term(
            "warranty-policy-duration",
            "store-ops",
            "warranty_generic_sections_extracted",
            F.avg(F.col("warranty_duration_months")),
        ),
        Term(
            "shelf-stock-ratio",
            "inventory-mgmt",
            "gold_inventory_reconciliation_ledger",
            ratio(F.sum("shelf_qty"), F.sum(on_hand_units())) * 100.0,
        ),
    )


def evaluate(tables: Mapping[str, DataFrame], digits: int = 4) -> DataFrame:
    """One row per term, one aggregation per table: terms of a table share its scan."""
    out = None
    for name in sorted({t.table for t in glossary()} & set(tables)):
        terms = [t for t in glossary() if t.table == name]
        if len({str(t.rows) for t in terms}) == 1 and terms[0].rows is not None:
            source = tables[name].filter(terms[0].rows)
        else:
            source = tables[name]
        row = source.agg(*[F.round(t.total.cast("double"), digits).alias(t.name) for t in terms])
        pairs = F.array(*[F.struct(F.lit(t.name).alias("term"), F.col(f"`{t.name}`").alias("value")) for t in terms])
        long = row.select(F.inline(pairs)).withColumn("target_table", F.lit(name))
        out = long if out is None else out.unionByName(long)
    return out
