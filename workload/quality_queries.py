"""Contract rules, scans, schema checks, profiles and serving-table checks."""

import uuid

from pyspark.sql import functions as F

from aislewise.operators import contracts as C
from aislewise.operators import quality as Q
from aislewise.operators import sketches as S
from aislewise.streaming import scoring, windows
from workload import views as V
from workload.document_queries import PAGES_SQL, page_fields
from workload.ledger_queries import LEDGER_CTE, ledger
from workload.registry import query
from workload.sales_queries import ALERTS_SQL, AS_OF, GOLD_SQL, as_of
from workload.stream_queries import SCORED_SQL, rolling

AS_OF_DATE = AS_OF[:10]


def baskets(spark, sf_dir):
    """Events as checkouts with one to four lines; a few carry a line their counter missed."""
    k = V.quantity()
    lines = F.transform(
        F.sequence(F.lit(1), F.lit(1) + k % 3 + (k % 10 == 0).cast("int")),
        lambda i: F.struct(i.alias("line_seq"), ((F.col("event_id") * 31 + i * 17) % 400).alias("item_id")),
    )
    return V.table(spark, sf_dir, "events").select(
        F.concat(F.lit("TXN-"), (F.col("event_id") - (k == 0).cast("int")).cast("string")).alias("transaction_id"),
        F.when(k % 50 == 1, F.lit("not a time")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("event_timestamp"),
        F.to_date("ts").alias("business_date"),
        V.cashier_of("user_id").alias("cashier_id"),
        F.col("value").alias("total"),
        F.col("value").alias("total_amount_usd"),
        (1 + k % 3).alias("item_count"),
        lines.alias("items"),
    )


def warranties(spark, sf_dir):
    pages = V.table(spark, sf_dir, "pages").select("page_id", "html")
    months = (F.col("ad_number") % 36).alias("warranty_duration_months")
    return page_fields(spark, sf_dir).join(pages, "page_id").select(
        F.col("page_id").alias("product_id"),
        F.col("title").alias("product_name"),
        F.col("ad_number").cast("double").alias("retail_price_usd"),
        months,
        F.col("html").alias("extracted_full_content"),
        F.col("url").alias("source_pdf_uri"),
    )


def objects(spark, sf_dir):
    """Every page as a stored object. Some have moved since their address was read, and some are stored twice."""
    moved = F.when(F.col("page_id") % 7 == 3, F.concat("url", F.lit("#moved"))).otherwise(F.col("url"))
    again = F.when(F.col("page_id") % 11 == 5, F.array(moved, F.concat("url", F.lit("#copy")))).otherwise(F.array(moved))
    return V.table(spark, sf_dir, "pages").select(F.explode(again).alias("uri"))


BASKETS_SQL = """
keyed AS (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events),
baskets AS (
  SELECT 'TXN-' || (event_id - CASE WHEN k = 0 THEN 1 ELSE 0 END) AS transaction_id,
         CASE WHEN k % 50 = 1 THEN 'not a time' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS event_timestamp,
         CAST(ts AS DATE) AS business_date, 'CASH_' || (user_id + 1000) AS cashier_id, value AS total,
         value AS total_amount_usd, 1 + k % 3 AS item_count,
         list_transform(range(1, 2 + k % 3 + CASE WHEN k % 10 = 0 THEN 1 ELSE 0 END),
                        lambda i: (event_id * 31 + i * 17) % 400) AS items
  FROM keyed
)"""
WARRANTY_SQL = f"""{PAGES_SQL},
warr AS (
  SELECT page_id AS product_id, title AS product_name, CAST(ad_number AS DOUBLE) AS retail_price_usd,
         ad_number % 36 AS warranty_duration_months, html AS extracted_full_content, url AS source_pdf_uri
  FROM fields JOIN (SELECT page_id, html FROM pages) USING (page_id)
),
objects AS (
  SELECT CASE WHEN page_id % 7 = 3 THEN url || '#moved' ELSE url END AS uri FROM pages
  UNION ALL SELECT url || '#copy' FROM pages WHERE page_id % 11 = 5
)"""


def _fraction(predicate):
    return f"count(*) FILTER ({predicate}) / nullif(CAST(count(*) AS DOUBLE), 0e0)"


def _unique(key):
    return f"count(DISTINCT {key}) / nullif(CAST(count({key}) AS DOUBLE), 0e0)"


_PAIRED = (
    "(alert_type = 'order_anomaly' AND alert_source = 'order_anomaly_model') OR "
    "(alert_type = 'cashier_promo_abuse' AND alert_source = 'cashier_abuse_model')"
)
# contract, rule, dimension, operator, threshold, value, table
RULE_VALUES = [
    ("pos_transactions_gold", "intraday_partition_present", "timeliness", ">=", 1, f"count(*) FILTER (business_date = DATE '{AS_OF_DATE}')", "baskets"),
    ("pos_transactions_gold", "total_amount_non_negative", "validity", ">=", 1, _fraction("total >= 0"), "baskets"),
    ("pos_transactions_gold", "item_count_matches_items_array", "consistency", ">=", 0.99, _fraction("item_count = len(items)"), "baskets"),
    ("pos_anomaly_alerts", "alert_type_enumerated", "validity", ">=", 1, _fraction("alert_type IN ('order_anomaly', 'cashier_promo_abuse')"), "alerts"),
    ("pos_anomaly_alerts", "alert_source_matches_alert_type", "consistency", ">=", 0.99, _fraction(_PAIRED), "alerts"),
    ("pos_anomaly_alerts", "risk_score_probability_range", "validity", ">=", 1, _fraction("risk_score BETWEEN 0 AND 1"), "alerts"),
    ("pos_anomaly_alerts", "rolling_7day_window_populated", "timeliness", ">=", 1, f"count(*) FILTER (alert_type = 'cashier_promo_abuse' AND alert_ts >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY)", "alerts"),
    ("gold_inventory_reconciliation_ledger", "cover_hours_non_negative", "validity", ">=", 1, _fraction("est_cover_hours_remaining >= 0"), "ledger"),
    ("gold_inventory_reconciliation_ledger", "reconciliation_status_enumerated", "consistency", ">=", 1, _fraction("reconciliation_status IN ('CRITICAL BURN SPIKE - STOCKOUT RISK', 'MONITOR VELOCITY', 'RECONCILED NORMAL HEALTH')"), "ledger"),
    ("gold_inventory_reconciliation_ledger", "store_item_date_grain_unique", "uniqueness", ">=", 1, "count(DISTINCT (business_date, store_id, item_id)) / nullif(CAST(count(*) AS DOUBLE), 0e0)", "ledger"),
    ("gold_inventory_reconciliation_ledger", "quantities_non_negative", "validity", ">=", 1, _fraction("shelf_qty >= 0 AND backroom_qty >= 0 AND opening_qty >= 0"), "ledger"),
    ("historical_transactional_data", "items_array_non_empty", "completeness", ">=", 1, _fraction("len(items) >= 1"), "baskets"),
    ("historical_transactional_data", "transaction_id_not_null", "completeness", ">=", 1, _fraction("transaction_id IS NOT NULL"), "baskets"),
    ("historical_transactional_data", "transaction_id_unique", "uniqueness", ">=", 1, _unique("transaction_id"), "baskets"),
    ("historical_transactional_data", "business_date_not_null", "completeness", ">=", 1, _fraction("business_date IS NOT NULL"), "baskets"),
    ("historical_transactional_data", "total_amount_usd_non_negative", "validity", ">=", 1, _fraction("total_amount_usd >= 0"), "baskets"),
    ("historical_transactional_data", "item_count_matches_items_array", "consistency", ">=", 1, _fraction("item_count = len(items)"), "baskets"),
    ("warranty_generic_sections_extracted", "product_id_not_null", "completeness", ">=", 1, _fraction("product_id IS NOT NULL"), "warr"),
    ("warranty_generic_sections_extracted", "product_id_unique", "uniqueness", ">=", 1, _unique("product_id"), "warr"),
    ("warranty_generic_sections_extracted", "product_name_not_null", "completeness", ">=", 1, _fraction("product_name <> ''"), "warr"),
    ("warranty_generic_sections_extracted", "retail_price_present_and_positive", "validity", ">=", 1, _fraction("retail_price_usd > 0"), "warr"),
    ("warranty_generic_sections_extracted", "warranty_duration_present_and_positive", "validity", ">=", 1, _fraction("warranty_duration_months > 0"), "warr"),
    ("warranty_generic_sections_extracted", "extracted_content_minimum_length", "completeness", ">=", 1, _fraction("length(extracted_full_content) >= 800"), "warr"),
    ("silver_pos_transactions", "cashier_id_not_null", "completeness", ">=", 1, _fraction("cashier_id IS NOT NULL"), "baskets"),
    ("silver_pos_transactions", "event_timestamp_parseable", "validity", ">=", 1, _fraction("TRY_CAST(event_timestamp AS TIMESTAMP) IS NOT NULL"), "baskets"),
    ("silver_pos_transactions", "cashier_id_consistent_with_alerts", "consistency", ">=", 1, _fraction("regexp_matches(cashier_id, '^CASH_[0-9]+$')"), "baskets"),
    ("silver_pos_transactions", "transaction_id_not_null", "completeness", ">=", 1, _fraction("transaction_id IS NOT NULL"), "baskets"),
    ("silver_pos_transactions", "transaction_id_unique", "uniqueness", ">=", 1, _unique("transaction_id"), "baskets"),
    ("silver_pos_transactions", "total_amount_usd_non_negative", "validity", ">=", 1, _fraction("total_amount_usd >= 0"), "baskets"),
]
CROSS_VALUES = [
    ("historical_transactional_data", "item_id_joinable_to_warranty_catalog", "consistency", ">=", 1, "count(DISTINCT i)", "(SELECT unnest(items) AS i FROM baskets) JOIN warr ON i = product_id"),
    ("warranty_generic_sections_extracted", "row_count_matches_pdf_corpus", "completeness", "==", 1, "CASE WHEN (SELECT count(*) FROM warr) = (SELECT count(*) FROM objects) THEN 1 ELSE 0 END", "(SELECT 1)"),
    ("warranty_generic_sections_extracted", "source_pdf_uri_resolvable", "consistency", ">=", 1, _fraction("source_pdf_uri IN (SELECT uri FROM objects)"), "warr"),
    ("silver_pos_transactions", "federated_catalog_readable", "timeliness", ">=", 1, "count(*)", "(SELECT transaction_id FROM baskets LIMIT 10)"),
]
KV_PREFIX = "STORE_041#CASH_1041#"


def _kv(rule, dimension, value, operator="==", threshold=0):
    return ("cashier_realtime_alerts", rule, dimension, operator, threshold, value, "kv")


_IN_ORDER = """(split_part(row_key, '#', -1)
  IS NOT DISTINCT FROM lpad(CAST(9223372036854775807 - epoch_us(last_event_ts) AS VARCHAR), 19, '0'))"""
KV_VALUES = [
    _kv("row_key_prefix_exists", "completeness", f"count(*) FILTER (starts_with(row_key, '{KV_PREFIX}'))", ">=", 1),
    _kv("row_key_format_valid", "validity", "count(*) FILTER (NOT regexp_matches(row_key, '^STORE_[0-9]{3}#CASH_[0-9]+#[0-9]+$'))"),
    _kv("risk_score_in_unit_range", "validity", "count(*) FILTER (risk_score < 0 OR risk_score > 1)"),
    _kv("audit_status_allowed_values", "validity", "count(*) FILTER (audit_status NOT IN ('clear', 'review'))"),
    _kv("counters_non_negative", "validity", "count(*) FILTER (cashier_1h_txn_count < 0) + count(*) FILTER (cashier_1h_manual_override_count < 0)"),
    _kv("promo_rate_in_unit_range", "validity", "count(*) FILTER (cashier_1h_promo_rate < 0 OR cashier_1h_promo_rate > 1)"),
    _kv("core_qualifiers_present", "completeness", "count(*) FILTER (risk_score IS NULL) + count(*) FILTER (cashier_1h_txn_count IS NULL) + count(*) FILTER (audit_status IS NULL)"),
    # Every key under the prefix ends in the reversed time of its own row, so keys in order are rows from new to old.
    _kv("newest_row_first_on_prefix_scan", "timeliness", f"""CASE WHEN count(*) FILTER (starts_with(row_key, '{KV_PREFIX}') AND NOT {_IN_ORDER}) = 0
       AND count(*) FILTER (starts_with(row_key, '{KV_PREFIX}')) >= 1 THEN 1 ELSE 0 END""", ">=", 1),
    _kv("override_count_not_exceeding_txn_count", "consistency", "count(*) FILTER (cashier_1h_manual_override_count > cashier_1h_txn_count)"),
]

def _results_sql(ctes, values):
    parts = []
    for contract, rule, dimension, op, threshold, value, source in values:
        sql_op = "=" if op == "==" else op
        parts.append(
            f"SELECT '{contract}' AS contract, '{rule}' AS rule_id, '{dimension}' AS dimension, CAST(v AS DOUBLE) AS value, "
            f"'{op}' AS operator, CAST({threshold} AS DOUBLE) AS threshold, coalesce(v {sql_op} {threshold}, FALSE) AS ok "
            f"FROM (SELECT {value} AS v FROM {source})"
        )
    return f"WITH {ctes} " + " UNION ALL ".join(parts)


RULES_SQL = _results_sql(f"{BASKETS_SQL}, {ALERTS_SQL}, {LEDGER_CTE}, {WARRANTY_SQL}", RULE_VALUES)
CROSS_SQL = _results_sql(f"{BASKETS_SQL}, {WARRANTY_SQL}", CROSS_VALUES)
KV_SQL = f"""{SCORED_SQL},
kv AS (
  SELECT *, store_id || '#' || cashier_id || '#' ||
         lpad(CAST(9223372036854775807 - epoch_us(last_event_ts) AS VARCHAR), 19, '0') AS row_key FROM scored
)"""


def serving(spark, sf_dir):
    return windows.serving_rows(scoring.score_cashiers(rolling(spark, sf_dir)))


def table_results(spark, sf_dir):
    history = baskets(spark, sf_dir)
    return C.check_all(
        {
            "pos_transactions_gold": history,
            "pos_anomaly_alerts": V.alerts(spark, sf_dir),
            "gold_inventory_reconciliation_ledger": ledger(spark, sf_dir),
            "historical_transactional_data": history,
            "warranty_generic_sections_extracted": warranties(spark, sf_dir),
            "silver_pos_transactions": history,
        },
        as_of(),
        AS_OF_DATE,
    )


@query("contract_rules", RULES_SQL)
def contract_rules(spark, sf_dir):
    return table_results(spark, sf_dir)


@query("contract_cross_rules", CROSS_SQL)
def contract_cross_rules(spark, sf_dir):
    history = baskets(spark, sf_dir)
    return C.cross_table_checks(history, warranties(spark, sf_dir), objects(spark, sf_dir), history)


@query("kv_checks", _results_sql(KV_SQL, KV_VALUES))
def kv_checks(spark, sf_dir):
    return Q.kv_checks(serving(spark, sf_dir), KV_PREFIX)


KV_BROKEN_SQL = f"""{KV_SQL.rsplit("kv AS (", 1)[0]}whole AS ({KV_SQL.rsplit("kv AS (", 1)[1]},
kv AS (
  SELECT * REPLACE (
    CASE WHEN s % 7 = 0 THEN risk_score + 2 WHEN s % 7 = 1 THEN NULL ELSE risk_score END AS risk_score,
    CASE WHEN s % 11 = 0 THEN 'odd' ELSE audit_status END AS audit_status,
    CASE WHEN s % 13 = 0 THEN -cashier_1h_txn_count ELSE cashier_1h_txn_count END AS cashier_1h_txn_count,
    CASE WHEN s % 5 = 0 THEN cashier_1h_promo_rate + 1.5 ELSE cashier_1h_promo_rate END AS cashier_1h_promo_rate,
    CASE WHEN s % 3 = 0 THEN store_id || '#' || cashier_id || '#' || lpad(CAST(epoch_us(last_event_ts) AS VARCHAR), 19, '0')
         WHEN s % 17 = 0 THEN 'x' || row_key ELSE row_key END AS row_key)
  FROM (SELECT *, CAST(floor(epoch(last_event_ts)) AS BIGINT) AS s FROM whole)
)"""


def broken_serving(spark, sf_dir):
    """The serving rows with faults put in by their time's second."""
    s = F.unix_seconds("last_event_ts")
    plain = F.concat_ws("#", "store_id", "cashier_id", F.lpad(F.unix_micros("last_event_ts").cast("string"), 19, "0"))
    return serving(spark, sf_dir).withColumns(
        {
            "risk_score": F.when(s % 7 == 0, F.col("risk_score") + 2).when(s % 7 != 1, F.col("risk_score")),
            "audit_status": F.when(s % 11 == 0, "odd").otherwise(F.col("audit_status")),
            "cashier_1h_txn_count": F.when(s % 13 == 0, -F.col("cashier_1h_txn_count")).otherwise(F.col("cashier_1h_txn_count")),
            "cashier_1h_promo_rate": F.when(s % 5 == 0, F.col("cashier_1h_promo_rate") + 1.5).otherwise(F.col("cashier_1h_promo_rate")),
            "row_key": F.when(s % 3 == 0, plain).when(s % 17 == 0, F.concat(F.lit("x"), "row_key")).otherwise(F.col("row_key")),
        }
    )


@query("kv_checks_broken", _results_sql(KV_BROKEN_SQL, KV_VALUES))
def kv_checks_broken(spark, sf_dir):
    """The same nine checks over rows with faults."""
    return Q.kv_checks(broken_serving(spark, sf_dir), KV_PREFIX)


@query(
    "contract_summary",
    f"""SELECT contract, count(*) FILTER (ok) AS passed, count(*) FILTER (NOT ok) AS failed, bool_and(ok) AS all_ok
FROM ({RULES_SQL}) GROUP BY 1""",
)
def contract_summary(spark, sf_dir):
    return Q.summary(table_results(spark, sf_dir))


KV_SOME_WRONG_SQL = f"""{KV_SQL}, partly AS (
  SELECT * REPLACE (CASE WHEN store_id IN ('STORE_003', 'STORE_041') AND epoch_us(last_event_ts) % 3 = 0
    THEN store_id || '#' || cashier_id || '#' || lpad(CAST(epoch_us(last_event_ts) AS VARCHAR), 19, '0') ELSE row_key END AS row_key)
  FROM kv
)"""


@query(
    "kv_newest_first",
    f"""WITH {KV_SOME_WRONG_SQL}
SELECT store_id || '#' || cashier_id AS prefix, count(*) AS rows, bool_and({_IN_ORDER}) AS newest_first FROM partly GROUP BY 1""",
)
def kv_newest_first(spark, sf_dir):
    """Which cashiers' rows come newest first, where some keys of two stores were written with the plain time."""
    micros = F.unix_micros("last_event_ts")
    plain = F.concat_ws("#", "store_id", "cashier_id", F.lpad(micros.cast("string"), 19, "0"))
    wrong = F.col("store_id").isin("STORE_003", "STORE_041") & (micros % 3 == 0)
    rows = serving(spark, sf_dir).withColumn("row_key", F.when(wrong, plain).otherwise(F.col("row_key")))
    return Q.newest_first(rows)


@query(
    "kv_prefix_scan",
    f"""WITH {KV_SQL} SELECT row_key, risk_score, cashier_1h_txn_count, audit_status FROM kv
WHERE starts_with(row_key, '{KV_PREFIX}') ORDER BY row_key LIMIT 5""",
)
def kv_prefix_scan(spark, sf_dir):
    """The serving rows written in ranges of their keys; the prefix opens the files that can hold it."""
    from aislewise.session import shared_dir
    from aislewise.sources.key_ranges import prefix_rows, write_key_ranges

    path = f"{shared_dir(spark)}/serving-{uuid.uuid4().hex}"
    write_key_ranges(serving(spark, sf_dir), path)
    rows = prefix_rows(spark, path, KV_PREFIX, 5)
    return rows.select("row_key", "risk_score", "cashier_1h_txn_count", "audit_status")


@query(
    "dq_rules",
    f"""WITH {GOLD_SQL} SELECT 'pos-transactions-quality' AS contract, * FROM (
SELECT 'transaction_id_not_null' AS rule_id, 'COMPLETENESS' AS dimension, {_fraction('transaction_id IS NOT NULL')} AS value,
       '>=' AS operator, 1e0 AS threshold, count(*) FILTER (transaction_id IS NOT NULL) = count(*) AS ok FROM gold
UNION ALL SELECT 'total_identity', 'VALIDITY', {_fraction('total = subtotal_amount - discount + tax_amount')}, '>=', 1e0,
       count(*) FILTER (total = subtotal_amount - discount + tax_amount) = count(*) FROM gold
UNION ALL SELECT 'item_count_within_quantity', 'VALIDITY', {_fraction('item_count <= total_quantity')}, '>=', 1e0,
       count(*) FILTER (item_count <= total_quantity) = count(*) FROM gold)""",
)
def dq_rules(spark, sf_dir):
    return Q.evaluate(V.gold_checkouts(spark, sf_dir), "pos-transactions-quality", C.gold_scan_rules())


def _profile_sql(table, columns):
    parts = [
        f"""SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_nulls,
round((count(*) - count({c})) / CAST(count(*) AS DOUBLE), 6) AS null_ratio, count(DISTINCT {c}) AS n_distinct,
(SELECT max(n) FROM (SELECT count(*) AS n FROM {table} WHERE {c} IS NOT NULL GROUP BY {c})) AS top_count,
{f'CAST(min({c}) AS DOUBLE)' if numeric else 'CAST(NULL AS DOUBLE)'} AS min_number,
{f'CAST(max({c}) AS DOUBLE)' if numeric else 'CAST(NULL AS DOUBLE)'} AS max_number FROM {table}"""
        for c, numeric in columns
    ]
    return " UNION ALL ".join(parts)


LINE_COLUMNS = [
    ("l_orderkey", 1), ("l_partkey", 1), ("l_suppkey", 1), ("l_linenumber", 1), ("l_quantity", 1),
    ("l_extendedprice", 1), ("l_discount", 1), ("l_tax", 1), ("l_returnflag", 0), ("l_linestatus", 0), ("l_shipdate", 0),
]


@query("profile_columns", _profile_sql("lineitem", LINE_COLUMNS))
def profile_columns(spark, sf_dir):
    return Q.profile(V.table(spark, sf_dir, "lineitem"))


def _sketch_sql(table, columns):
    parts = [
        f"""SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_nulls,
round((count(*) - count({c})) / CAST(count(*) AS DOUBLE), 6) AS null_ratio,
{f'CAST(min({c}) AS DOUBLE) + 0e0' if numeric else 'CAST(NULL AS DOUBLE)'} AS low,
{f'CAST(max({c}) AS DOUBLE) + 0e0' if numeric else 'CAST(NULL AS DOUBLE)'} AS high, TRUE AS distinct_ok, TRUE AS quantiles_ok FROM {table}"""
        for c, numeric in columns
    ]
    return " UNION ALL ".join(parts)


def _month_sketches(spark, sf_dir):
    """Sketches of the order lines by month, written in two runs as new months come in: the second costs its months only."""
    from aislewise.session import shared_dir

    lines = V.table(spark, sf_dir, "lineitem")
    month = F.trunc(F.col("l_shipdate").cast("date"), "month")
    path = f"{shared_dir(spark)}/sketches-{uuid.uuid4().hex}"
    names = [c for c, _ in LINE_COLUMNS]
    late = F.coalesce(F.col("l_shipdate").cast("date") >= F.lit("2001-01-01").cast("date"), F.lit(False))
    for part in (~late, late):
        S.store_days(S.day_sketches(lines.where(part), month, names), path)
    return S.stored(spark, path)


@query("quick_profile", _sketch_sql("lineitem", LINE_COLUMNS))
def quick_profile(spark, sf_dir):
    """The profile from stored sketches of each month, and whether its estimates lie within the sketches' stated errors."""
    profiled = S.profile(_month_sketches(spark, sf_dir))
    checked = S.within_error(V.table(spark, sf_dir, "lineitem"), profiled)
    return profiled.join(checked, "column_name").select(
        "column_name", "n_rows", "n_nulls", "null_ratio", "low", "high", "distinct_ok", "quantiles_ok"
    )


TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@query("table_counts", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES))
def table_counts(spark, sf_dir):
    return Q.tables_inventory({t: V.table(spark, sf_dir, t) for t in TABLES})
