"""The contracted tables: their columns and the rules that watch them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aislewise.functions.time import event_time, within_days
from aislewise.operators import ledger as L
from aislewise.operators.quality import Rule, counted, evaluate_all, holds, referenced_ratio, same_count, value_rule
from aislewise.operators.sales import ALERT_SOURCE, ORDER_ANOMALY, PROMO_ABUSE

# Contracted columns.
_MONEY = "decimal(38,9)"
SCHEMAS = {
    "pos_transactions_gold": f"""transaction_id string, event_timestamp timestamp, business_date date, store_id string,
        pos_terminal_id string, cashier_id string, customer_id string, customer_loyalty_tier string,
        payment_method string, payment_network string, card_bin string, is_contactless boolean, currency string,
        item_count bigint, total_quantity bigint, subtotal_amount {_MONEY}, discount {_MONEY}, tax_amount {_MONEY},
        total {_MONEY}, promo_code_applied string, manual_discount_flag boolean,
        items array<struct<line_seq: bigint, item_id: string, item_name: string, category: string, quantity: bigint,
        unit_price: {_MONEY}, total: {_MONEY}, discount: {_MONEY}, item_net_amount: {_MONEY}>>""",
    "pos_anomaly_alerts": """alert_id string, store_id string, alert_type string, alert_source string,
        transaction_id string, cashier_id string, discount_pct double, risk_score double, alert_ts timestamp""",
    "gold_inventory_reconciliation_ledger": """business_date date, store_id string, store_name string, city string,
        item_id string, unit_price_usd double, opening_qty bigint, shelf_qty bigint, backroom_qty bigint,
        intraday_gross_revenue_usd double, est_cover_hours_remaining double, reconciliation_status string""",
    "historical_transactional_data": """transaction_id string, event_timestamp timestamp, store_id string,
        store_name string, global_region string, pos_terminal_id string, cashier_id string, customer_id string,
        customer_name string, customer_loyalty_tier string, payment_method string, payment_network string,
        card_bin string, card_number string, is_contactless boolean, currency string, item_count bigint,
        total_item_quantity bigint, subtotal_amount double, subtotal_amount_usd double, discount_amount double,
        tax_amount double, total_amount double, total_amount_usd double, promo_code_applied string,
        manual_discount_flag boolean, items array<struct<line_seq: bigint, item_id: string, item_name: string,
        category: string, quantity: bigint, unit_price: double, total: double, discount: double,
        item_net_amount: double>>, _ingested_at string, _source_file string, _batch_id string,
        _msk_message_id string, business_date date""",
    "warranty_generic_sections_extracted": """product_id string, product_name string, brand string, category string,
        retail_price_usd double, warranty_duration_months bigint, warranty_start string, coverage_type string,
        service_level string, service_region string, coverage_scope_details string, exclusions_and_limitations string,
        official_retailer_guarantee_and_sla string, support_and_claims_process string, support_url string,
        support_email string, extracted_full_content string, source_pdf_uri string""",
    "silver_pos_transactions": """transaction_id string, event_timestamp string, store_id string, store_name string,
        global_region string, pos_terminal_id string, cashier_id string, customer_id string, customer_name string,
        customer_loyalty_tier string, payment_method string, total_item_quantity bigint, total_amount double,
        total_amount_usd double, currency string, contains_harmful_batch boolean""",
    "cashier_realtime_alerts": """row_key string, cashier_1h_avg_discount_pct double,
        cashier_1h_manual_override_count bigint, cashier_1h_promo_count bigint, cashier_1h_promo_rate double,
        cashier_1h_total_discount_usd double, cashier_1h_txn_count bigint, last_event_ts string, risk_score double,
        audit_status string""",
}


def schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(SCHEMAS[name])


def _all_true(*conditions: Column) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def gold_rules(as_of_date: str) -> list[Rule]:
    today = F.lit(as_of_date).cast("date")
    return [
        counted("intraday_partition_present", "timeliness", F.col("business_date") == today),
        holds("total_amount_non_negative", "validity", F.col("total") >= 0),
        holds("item_count_matches_items_array", "consistency", F.col("item_count") == F.size("items"), 0.99),
    ]


def gold_scan_rules() -> list[Rule]:
    """The quality scan of the gold checkouts."""
    identity = F.col("total") == F.col("subtotal_amount") - F.col("discount") + F.col("tax_amount")
    return [
        holds("transaction_id_not_null", "COMPLETENESS", F.col("transaction_id").isNotNull()),
        holds("total_identity", "VALIDITY", identity),
        holds("item_count_within_quantity", "VALIDITY", F.col("item_count") <= F.col("total_quantity")),
    ]


def alert_rules(as_of: Column) -> list[Rule]:
    kind, source = F.col("alert_type"), F.col("alert_source")
    paired = ((kind == ORDER_ANOMALY) & (source == ALERT_SOURCE[ORDER_ANOMALY])) | (
        (kind == PROMO_ABUSE) & (source == ALERT_SOURCE[PROMO_ABUSE])
    )
    return [
        holds("alert_type_enumerated", "validity", kind.isin(ORDER_ANOMALY, PROMO_ABUSE)),
        holds("alert_source_matches_alert_type", "consistency", paired, 0.99),
        holds("risk_score_probability_range", "validity", F.col("risk_score").between(0.0, 1.0)),
        counted(
            "rolling_7day_window_populated", "timeliness", (kind == PROMO_ABUSE) & within_days(F.col("alert_ts"), as_of, 7)
        ),
    ]


def ledger_rules() -> list[Rule]:
    hours = F.col("est_cover_hours_remaining")
    quantities = [F.col(c) >= 0 for c in ("shelf_qty", "backroom_qty", "opening_qty")]
    return [
        holds("cover_hours_non_negative", "validity", hours.isNotNull() & (hours >= 0)),
        holds(
            "reconciliation_status_enumerated",
            "consistency",
            F.col("reconciliation_status").isin(L.STATUS_CRITICAL, L.STATUS_MONITOR, L.STATUS_NORMAL),
        ),
        Rule("store_item_date_grain_unique", "uniqueness", unique=("business_date", "store_id", "item_id")),
        holds("quantities_non_negative", "validity", _all_true(*quantities)),
    ]


def history_rules() -> list[Rule]:
    return [
        holds("items_array_non_empty", "completeness", F.size("items") >= 1),
        holds("transaction_id_not_null", "completeness", F.col("transaction_id").isNotNull()),
        Rule("transaction_id_unique", "uniqueness", unique=("transaction_id",)),
        holds("business_date_not_null", "completeness", F.col("business_date").isNotNull()),
        holds("total_amount_usd_non_negative", "validity", F.col("total_amount_usd") >= 0),
        holds("item_count_matches_items_array", "consistency", F.col("item_count") == F.size("items")),
    ]


def warranty_rules() -> list[Rule]:
    name, price, months = F.col("product_name"), F.col("retail_price_usd"), F.col("warranty_duration_months")
    return [
        holds("product_id_not_null", "completeness", F.col("product_id").isNotNull()),
        Rule("product_id_unique", "uniqueness", unique=("product_id",)),
        holds("product_name_not_null", "completeness", name.isNotNull() & (name != "")),
        holds("retail_price_present_and_positive", "validity", price.isNotNull() & (price > 0)),
        holds("warranty_duration_present_and_positive", "validity", months.isNotNull() & (months > 0)),
        holds("extracted_content_minimum_length", "completeness", F.length("extracted_full_content") >= 800),
    ]


def silver_rules() -> list[Rule]:
    return [
        holds("cashier_id_not_null", "completeness", F.col("cashier_id").isNotNull()),
        holds("event_timestamp_parseable", "validity", event_time("event_timestamp").isNotNull()),
        holds("cashier_id_consistent_with_alerts", "consistency", F.col("cashier_id").rlike("^CASH_[0-9]+$")),
        holds("transaction_id_not_null", "completeness", F.col("transaction_id").isNotNull()),
        Rule("transaction_id_unique", "uniqueness", unique=("transaction_id",)),
        holds("total_amount_usd_non_negative", "validity", F.col("total_amount_usd") >= 0),
    ]


def cross_table_checks(history: DataFrame, warranty: DataFrame, objects: DataFrame, silver: DataFrame) -> DataFrame:
    """The rules that need two tables, and the read probe of the federated one."""
    from aislewise.operators.warranty import join_coverage, purchase_lines

    lines = purchase_lines(history.select("items"))
    probe = silver.select("transaction_id").limit(10).agg(F.count(F.lit(1)).alias("value"))
    checks = [
        ("historical_transactional_data", Rule("item_id_joinable_to_warranty_catalog", "consistency"), join_coverage(lines, warranty)),
        (
            "warranty_generic_sections_extracted",
            Rule("row_count_matches_pdf_corpus", "completeness", operator="=="),
            same_count(warranty, objects),
        ),
        (
            "warranty_generic_sections_extracted",
            Rule("source_pdf_uri_resolvable", "consistency"),
            referenced_ratio(warranty, "source_pdf_uri", objects, "uri"),
        ),
        ("silver_pos_transactions", Rule("federated_catalog_readable", "timeliness"), probe),
    ]
    out = None
    for name, rule, value in checks:
        part = value_rule(name, rule, value)
        out = part if out is None else out.unionByName(part)
    return out


def check_all(tables: dict[str, DataFrame], as_of: Column, as_of_date: str) -> DataFrame:
    """Every table rule, in one pass per table, however many contracts it is under."""
    rules = {
        "pos_transactions_gold": gold_rules(as_of_date),
        "pos_anomaly_alerts": alert_rules(as_of),
        "gold_inventory_reconciliation_ledger": ledger_rules(),
        "historical_transactional_data": history_rules(),
        "warranty_generic_sections_extracted": warranty_rules(),
        "silver_pos_transactions": silver_rules(),
    }
    return evaluate_all([(name, tables[name], own) for name, own in rules.items() if name in tables])
