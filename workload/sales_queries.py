"""Deduplication, sales KPIs, alerts, warranty and retention queries."""

import uuid

from pyspark.sql import functions as F

from aislewise.functions.time import business_day
from aislewise.operators import changes, dedup, ledger, metrics, sales, warranty
from aislewise.sources.tables import bound_sql as bind
from workload import views as V
from workload.ledger_queries import LEDGER_CTE, positions
from workload.registry import query

AS_OF = "2024-01-30 20:00:00"
TRIAGE_DATE = "1999-06-30"

LINES_SQL = """
latest_lines AS (
  SELECT * FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS LAST,
    l_discount DESC, l_extendedprice DESC, l_linestatus DESC, l_partkey DESC, l_quantity DESC, l_returnflag DESC,
    l_suppkey DESC, l_tax DESC) = 1
),
order_lines AS (
  SELECT o_orderkey AS transaction_id, l_linenumber AS line_seq, o_custkey AS customer_id,
         CAST(o_orderdate AS DATE) AS business_date, printf('STORE_%03d', l_suppkey) AS store_id,
         l_partkey AS item_id, l_quantity AS quantity, CAST(l_extendedprice AS DECIMAL(18, 2)) AS price,
         CAST(l_discount AS DECIMAL(6, 2)) AS cut, CAST(l_tax AS DECIMAL(6, 2)) AS tax
  FROM latest_lines JOIN orders ON l_orderkey = o_orderkey
)"""

CHECKOUTS_SQL = """
checkouts AS (
  SELECT 'TXN-' || event_id AS transaction_id, ts AS event_ts, printf('STORE_%03d', user_id % 50) AS store_id,
         'CASH_' || (user_id + 1000) AS cashier_id, event_type AS payment_method,
         CAST(value AS DECIMAL(18, 2)) AS subtotal_amount,
         CAST(json_extract(props, '$.k') AS BIGINT) AS k,
         CAST(round(value * 100) AS BIGINT) * CAST(json_extract(props, '$.k') AS BIGINT) AS discount_e4,
         event_type = 'click' AS promo, event_type = 'error' AS manual_discount_flag
  FROM events
)"""

ALERTS_SQL = """
alerts AS (
  SELECT CASE WHEN event_type = 'error' THEN 'ALT-ANOMALY-' ELSE 'ALT-ABUSE-' END || event_id AS alert_id,
         printf('STORE_%03d', user_id % 50) AS store_id,
         CASE WHEN event_type = 'error' THEN 'order_anomaly' ELSE 'cashier_promo_abuse' END AS alert_type,
         CASE WHEN event_type = 'error' THEN 'order_anomaly_model' ELSE 'cashier_abuse_model' END AS alert_source,
         'TXN-' || event_id AS transaction_id, 'CASH_' || (user_id + 1000) AS cashier_id,
         CAST(json_extract(props, '$.k') AS BIGINT) / 100e0 AS discount_pct,
         round(value / (value + 100e0), 6) AS risk_score, ts AS alert_ts
  FROM events WHERE event_type IN ('error', 'click')
)"""

GOLD_SQL = f"""{LINES_SQL},
gold AS (
  SELECT *, subtotal_amount - discount + tax_amount AS total FROM (
    SELECT transaction_id, customer_id, business_date, count(*) AS item_count,
           CAST(sum(quantity) AS BIGINT) AS total_quantity, CAST(sum(price) AS DECIMAL(38, 9)) AS subtotal_amount,
           CAST(sum(price * cut) AS DECIMAL(38, 9)) AS discount,
           CAST(sum((price - price * cut) * tax) AS DECIMAL(38, 9)) AS tax_amount
    FROM order_lines GROUP BY transaction_id, customer_id, business_date)
)"""


def as_of():
    return sales.as_timestamp(AS_OF)


@query("dedup_latest", f"WITH {LINES_SQL} SELECT * FROM latest_lines")
def dedup_latest(spark, sf_dir):
    return dedup.latest_per_key(V.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query(
    "duplicate_report",
    """WITH variants AS (SELECT *, count(*) AS copies FROM lineitem GROUP BY ALL),
keys AS (SELECT l_orderkey, l_linenumber, sum(copies) AS copies, count(*) AS payloads FROM variants GROUP BY 1, 2)
SELECT 'lineitem' AS table_name, CAST(sum(copies) AS BIGINT) AS n_rows, count(*) AS n_keys,
       CAST(sum(copies - 1) AS BIGINT) AS surplus_rows, count(*) FILTER (copies = 2) AS keys_seen_twice,
       count(*) FILTER (copies >= 3) AS keys_seen_3_or_more, count(*) FILTER (payloads > 1) AS keys_with_conflicts
FROM keys""",
)
def duplicate_report(spark, sf_dir):
    return dedup.duplicate_report(
        V.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], name="lineitem"
    )


TXN_SQL = """
txn AS (
  SELECT o_orderkey AS transaction_id, CAST(o_orderdate AS DATE) AS business_date,
         printf('STORE_%03d', c_nationkey) AS store_id, o_orderpriority AS payment_method,
         CAST(o_totalprice AS DECIMAL(28, 9)) AS total
  FROM orders JOIN customer ON o_custkey = c_custkey
)"""


@query(
    "store_day_revenue",
    f"""WITH {TXN_SQL} SELECT business_date, store_id,
CAST(round(sum(total), 2) AS DOUBLE) AS intraday_gross_revenue_usd FROM txn GROUP BY ALL""",
)
def store_day_revenue(spark, sf_dir):
    txn = V.transactions(spark, sf_dir).withColumnRenamed("total", "total_amount_usd")
    return ledger.store_day_revenue(txn)


@query(
    "sku_day_units",
    f"""WITH {LINES_SQL} SELECT business_date, store_id, item_id, greatest(sum(quantity), 0e0) AS daily_units
FROM order_lines GROUP BY ALL""",
)
def sku_day_units(spark, sf_dir):
    return ledger.sku_day_units(V.order_lines(spark, sf_dir))


@query(
    "kpi_store_day",
    f"""WITH {TXN_SQL} SELECT business_date, store_id, CAST(round(sum(total), 2) AS DOUBLE) AS gross_revenue_usd,
count(*) AS txn_count, CAST(round(sum(total), 2) AS DOUBLE) / count(*) AS avg_basket_usd FROM txn GROUP BY ALL""",
)
def kpi_store_day(spark, sf_dir):
    return sales.store_day_kpis(V.transactions(spark, sf_dir))


@query(
    "intraday_kpis",
    f"""WITH {TXN_SQL} SELECT business_date, store_id, CAST(round(sum(total), 2) AS DOUBLE) AS gross_revenue_usd,
count(*) AS txn_count, CAST(round(sum(total), 2) AS DOUBLE) / count(*) AS avg_basket_usd
FROM txn WHERE business_date = DATE '1998-07-15' GROUP BY ALL""",
)
def intraday_kpis(spark, sf_dir):
    return sales.store_day_kpis(sales.intraday_sales(V.transactions(spark, sf_dir), "1998-07-15"))


@query(
    "payment_breakdown",
    f"""WITH {TXN_SQL} SELECT payment_method, count(*) AS txn_count, CAST(round(sum(total), 2) AS DOUBLE) AS revenue_usd,
round(CAST(sum(total) AS DOUBLE) / CAST((SELECT sum(total) FROM txn) AS DOUBLE) * 100e0, 2) AS revenue_share_pct
FROM txn GROUP BY 1""",
)
def payment_breakdown(spark, sf_dir):
    return sales.payment_breakdown(V.transactions(spark, sf_dir))


@query(
    "promo_alert_rate",
    f"""WITH {ALERTS_SQL} SELECT store_id, CAST(alert_ts AS DATE) AS alert_date, count(*) AS alerts,
round(count(*) FILTER (alert_type = 'cashier_promo_abuse') / CAST(count(*) AS DOUBLE) * 100e0, 2)
  AS promo_override_rate_pct
FROM alerts GROUP BY ALL""",
)
def promo_alert_rate(spark, sf_dir):
    return sales.promo_alert_rate(V.alerts(spark, sf_dir))


@query(
    "override_rate",
    f"""WITH {CHECKOUTS_SQL}, recent AS (
  SELECT *, event_ts >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY AS in_short FROM checkouts
  WHERE event_ts >= TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY AND event_ts <= TIMESTAMP '{AS_OF}')
SELECT cashier_id, count(*) FILTER (in_short) AS txn_count_7d, count(*) AS txn_count_30d,
       round(count(*) FILTER (in_short AND manual_discount_flag)
             / nullif(CAST(count(*) FILTER (in_short) AS DOUBLE), 0e0) * 100e0, 2) AS override_rate_7d_pct,
       round(count(*) FILTER (manual_discount_flag) / CAST(count(*) AS DOUBLE) * 100e0, 2) AS override_rate_30d_pct
FROM recent GROUP BY 1""",
)
def override_rate(spark, sf_dir):
    return sales.override_rates(V.checkouts(spark, sf_dir), as_of())


@query(
    "live_vs_baseline",
    f"""WITH {CHECKOUTS_SQL}, live AS (
  SELECT cashier_id, count(*) AS live_txn_count, count(*) FILTER (manual_discount_flag) AS live_override_count,
         round(count(*) FILTER (manual_discount_flag) / CAST(count(*) AS DOUBLE) * 100e0, 2) AS live_override_rate_pct
  FROM checkouts WHERE event_ts > TIMESTAMP '{AS_OF}' - INTERVAL 1 HOUR AND event_ts <= TIMESTAMP '{AS_OF}' GROUP BY 1),
base AS (
  SELECT cashier_id, round(count(*) FILTER (manual_discount_flag) / CAST(count(*) AS DOUBLE) * 100e0, 2) AS rate
  FROM checkouts WHERE event_ts >= TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY AND event_ts <= TIMESTAMP '{AS_OF}' GROUP BY 1)
SELECT cashier_id, live_txn_count, live_override_count, live_override_rate_pct, rate AS baseline_rate_pct,
       round(live_override_rate_pct / nullif(rate, 0e0), 2) AS times_baseline,
       round(live_override_rate_pct - rate, 2) AS difference_pct
FROM live LEFT JOIN base USING (cashier_id)""",
)
def live_vs_baseline(spark, sf_dir):
    return sales.live_against_baseline(V.checkouts(spark, sf_dir), as_of())


RANKING_SQL = f"""
ranking AS (
  SELECT store_id, cashier_id, count(alert_id) AS alert_count,
         round(CAST(sum(CAST(risk_score AS DECIMAL(28, 9))) AS DOUBLE) / count(risk_score), 4) AS avg_risk_score,
         max(risk_score) AS max_risk_score, max(alert_ts) AS latest_alert_ts
  FROM alerts WHERE alert_type = 'cashier_promo_abuse' AND alert_ts >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY
  GROUP BY ALL
)"""


@query(
    "offender_ranking",
    f"""WITH {ALERTS_SQL}, {RANKING_SQL} SELECT * FROM ranking
ORDER BY alert_count DESC, avg_risk_score DESC, store_id, cashier_id LIMIT 20""",
)
def offender_ranking(spark, sf_dir):
    return sales.offender_ranking(V.alerts(spark, sf_dir), as_of())


CHECKOUT_COLUMNS = ["transaction_id", "event_ts", "store_id", "cashier_id", "payment_method", "manual_discount_flag"]


@query(
    "offender_log",
    f"""WITH {ALERTS_SQL}, {RANKING_SQL}, {CHECKOUTS_SQL}
SELECT {', '.join(CHECKOUT_COLUMNS)} FROM checkouts WHERE cashier_id =
  (SELECT cashier_id FROM ranking ORDER BY alert_count DESC, avg_risk_score DESC, store_id, cashier_id LIMIT 1)
ORDER BY event_ts, transaction_id LIMIT 10""",
)
def offender_log(spark, sf_dir):
    log = sales.top_offender_log(V.alerts(spark, sf_dir), V.checkouts(spark, sf_dir), as_of())
    return log.select(*CHECKOUT_COLUMNS)


@query(
    "store_latest_alerts",
    f"""WITH {ALERTS_SQL} SELECT *, row_number() OVER (PARTITION BY store_id ORDER BY alert_ts DESC, alert_id) AS rank
FROM alerts WHERE alert_ts > TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR AND alert_ts <= TIMESTAMP '{AS_OF}'
QUALIFY rank <= 10""",
)
def store_latest_alerts(spark, sf_dir):
    return sales.newest_alerts_per_store(V.alerts(spark, sf_dir), as_of())


STOCK_SQL = """
readings AS (
  SELECT printf('STORE_%03d', user_id) AS store_id, event_type AS item_id, ts AS updated_at, event_id AS reading_id,
         CAST(json_extract(props, '$.k') AS BIGINT) AS on_hand_qty,
         CAST(json_extract(props, '$.k') AS BIGINT) % 7 AS reserved_qty
  FROM events
)"""


def stock_readings(spark, sf_dir):
    k = V.quantity().cast("long")
    return V.table(spark, sf_dir, "events").select(
        V.store_of("user_id").alias("store_id"),
        F.col("event_type").alias("item_id"),
        F.col("ts").cast("timestamp").alias("updated_at"),
        F.col("event_id").alias("reading_id"),
        k.alias("on_hand_qty"),
        (k % 7).alias("reserved_qty"),
    )


@query(
    "atp_latest",
    f"""WITH {STOCK_SQL} SELECT *, on_hand_qty - reserved_qty AS atp_qty FROM readings
QUALIFY row_number() OVER (PARTITION BY store_id, item_id ORDER BY updated_at DESC, on_hand_qty DESC, reading_id DESC) = 1""",
)
def atp_latest(spark, sf_dir):
    return sales.available_to_promise(stock_readings(spark, sf_dir))


@query(
    "latest_per_cashier",
    f"""WITH {CHECKOUTS_SQL} SELECT store_id, cashier_id, max(event_ts) AS event_ts,
arg_max(transaction_id, (event_ts, transaction_id)) AS transaction_id FROM checkouts GROUP BY ALL""",
)
def latest_per_cashier(spark, sf_dir):
    rows = V.checkouts(spark, sf_dir).select("store_id", "cashier_id", "event_ts", "transaction_id")
    return dedup.latest_per_key(rows, ["store_id", "cashier_id"], ["event_ts", "transaction_id"])


@query(
    "retention_compact",
    f"""WITH {STOCK_SQL} SELECT * FROM readings WHERE updated_at >= TIMESTAMP '{AS_OF}' - INTERVAL 14 DAY
QUALIFY row_number() OVER (PARTITION BY store_id, item_id ORDER BY updated_at DESC, on_hand_qty DESC, reading_id DESC) = 1""",
)
def retention_compact(spark, sf_dir):
    days = sales.RETENTION_DAYS["inventory"]
    return sales.compact(stock_readings(spark, sf_dir), ["store_id", "item_id"], "updated_at", as_of(), days)


@query(
    "retention_three_versions",
    f"""WITH {STOCK_SQL} SELECT *, row_number() OVER (PARTITION BY store_id, item_id
  ORDER BY updated_at DESC, on_hand_qty DESC, reading_id DESC, reserved_qty DESC) AS version
FROM readings WHERE updated_at >= TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY QUALIFY version <= 3""",
)
def retention_three_versions(spark, sf_dir):
    return sales.compact(stock_readings(spark, sf_dir), ["store_id", "item_id"], "updated_at", as_of(), 30, versions=3)


@query(
    "serving_compacted",
    f"""WITH {STOCK_SQL} SELECT * FROM readings WHERE updated_at >= TIMESTAMP '{AS_OF}' - INTERVAL 14 DAY
QUALIFY row_number() OVER (PARTITION BY store_id, item_id ORDER BY updated_at DESC, on_hand_qty DESC, reading_id DESC) = 1""",
)
def serving_compacted(spark, sf_dir):
    """All stock readings written in four batches, with a compaction after the second and after the last."""
    from aislewise.functions.keys import salt_bucket
    from aislewise.session import shared_dir
    from aislewise.streaming import compaction
    from aislewise.streaming.jobs import write_batch

    path = f"{shared_dir(spark)}/stock-{uuid.uuid4().hex}"
    readings = stock_readings(spark, sf_dir)
    names = readings.columns
    days = sales.RETENTION_DAYS["inventory"]

    def rewrite(rows):
        return sales.compact(rows, ["store_id", "item_id"], "updated_at", as_of(), days)

    for batch in range(4):
        part = readings.where(F.pmod(F.col("reading_id"), F.lit(4)) == batch)
        write_batch(part.withColumn("salt", salt_bucket(F.concat_ws("#", "store_id", "item_id"))), path, batch, ("salt",))
        if batch in (1, 3):
            compaction.compact_table(spark, path, rewrite)
    return compaction.current(spark, path).select(*names)


ORDER_VERSIONS_SQL = """
first_version AS (SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderkey % 10 <> 0),
second_version AS (
  SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 5 = 1 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
         CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus
  FROM orders WHERE o_orderkey % 7 <> 0
)"""


def order_versions(spark, sf_dir):
    """Two versions of the orders: some come, some go, some change their price, some lose their status."""
    orders = V.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    key = F.col("o_orderkey")
    price = F.when(key % 5 == 1, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    status = F.when(key % 11 != 0, F.col("o_orderstatus"))
    after = orders.where(key % 7 != 0).withColumns({"o_totalprice": price, "o_orderstatus": status})
    return orders.where(key % 10 != 0), after


@query(
    "change_feed",
    f"""WITH {ORDER_VERSIONS_SQL}
SELECT o_orderkey, CASE WHEN b.o_custkey IS NULL THEN 'insert' WHEN a.o_custkey IS NULL THEN 'delete' ELSE 'update' END AS change,
  b.o_totalprice AS price_before, a.o_totalprice AS price_after, b.o_orderstatus AS status_before, a.o_orderstatus AS status_after
FROM first_version b FULL JOIN second_version a USING (o_orderkey)
WHERE (b.o_custkey, b.o_totalprice, b.o_orderstatus) IS DISTINCT FROM (a.o_custkey, a.o_totalprice, a.o_orderstatus)""",
)
def change_feed(spark, sf_dir):
    """What changed between two versions of the orders, with the rows before and after."""
    before, after = order_versions(spark, sf_dir)
    feed = changes.changes(before, after, ["o_orderkey"], 2)
    return feed.select(
        "o_orderkey", "change", F.col("before.o_totalprice").alias("price_before"), F.col("after.o_totalprice").alias("price_after"),
        F.col("before.o_orderstatus").alias("status_before"), F.col("after.o_orderstatus").alias("status_after"),
    )


@query("change_replay", f"WITH {ORDER_VERSIONS_SQL} SELECT * FROM second_version")
def change_replay(spark, sf_dir):
    """The second version rebuilt: an empty table, then the first version's inserts, then the changes between the two."""
    before, after = order_versions(spark, sf_dir)
    nothing = before.limit(0)
    feed = changes.changes(nothing, before, ["o_orderkey"], 1).unionByName(changes.changes(before, after, ["o_orderkey"], 2))
    return changes.apply(nothing, feed, ["o_orderkey"])


TRIAGE_SQL = f"""{LINES_SQL},
triaged AS (
  SELECT transaction_id, line_seq, customer_id, business_date, store_id, item_id, p_name AS product_name,
         CAST(p_size AS BIGINT) AS warranty_duration_months, p_type AS service_level,
         date_diff('month', business_date, DATE '{TRIAGE_DATE}') AS months_elapsed,
         CASE WHEN date_diff('month', business_date, DATE '{TRIAGE_DATE}') <= p_size THEN 'COVERED'
              ELSE 'EXPIRED' END AS warranty_status
  FROM order_lines JOIN part ON item_id = p_partkey
)"""
TRIAGE_COLUMNS = [
    "transaction_id", "line_seq", "customer_id", "business_date", "store_id", "item_id", "product_name",
    "warranty_duration_months", "service_level", "months_elapsed", "warranty_status",
]


def triaged(spark, sf_dir):
    day = F.lit(TRIAGE_DATE).cast("date")
    return warranty.triage(V.order_lines(spark, sf_dir), V.policies(spark, sf_dir), day).select(*TRIAGE_COLUMNS)


@query("warranty_triage", f"WITH {TRIAGE_SQL} SELECT * FROM triaged")
def warranty_triage(spark, sf_dir):
    return triaged(spark, sf_dir)


@query(
    "warranty_latest_purchase",
    f"""WITH {TRIAGE_SQL} SELECT * FROM triaged QUALIFY row_number() OVER (PARTITION BY customer_id
  ORDER BY business_date DESC, transaction_id DESC, line_seq DESC) = 1""",
)
def warranty_latest_purchase(spark, sf_dir):
    return warranty.latest_purchase(triaged(spark, sf_dir))


@query(
    "warranty_join_coverage",
    f"WITH {LINES_SQL} SELECT count(DISTINCT item_id) AS value FROM order_lines JOIN part ON item_id = p_partkey",
)
def warranty_join_coverage(spark, sf_dir):
    return warranty.join_coverage(V.order_lines(spark, sf_dir), V.policies(spark, sf_dir))


@query(
    "business_day_sales",
    """SELECT CAST(ts - INTERVAL 4 HOUR AS DATE) AS business_date, count(*) AS txn_count,
CAST(round(sum(CAST(value AS DECIMAL(28, 9))), 2) AS DOUBLE) AS gross_revenue_usd,
count(*) FILTER (CAST(ts AS DATE) <> CAST(ts - INTERVAL 4 HOUR AS DATE)) AS moved_to_day_before
FROM events GROUP BY 1""",
)
def business_day_sales(spark, sf_dir):
    e = V.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    day = business_day(F.col("ts"))
    return e.groupBy(day.alias("business_date")).agg(
        F.count(F.lit(1)).alias("txn_count"),
        F.round(F.sum(F.col("value").cast("decimal(28,9)")), 2).cast("double").alias("gross_revenue_usd"),
        F.count_if(F.to_date("ts") != day).alias("moved_to_day_before"),
    )


@query(
    "glossary_metrics",
    f"""WITH {GOLD_SQL}, {LEDGER_CTE}, {ALERTS_SQL}
SELECT 'pos_transactions_gold' AS target_table, 'net-transaction-revenue' AS term,
       round(CAST(sum(subtotal_amount - discount + tax_amount) AS DOUBLE), 4) AS value FROM gold WHERE total > 0
UNION ALL SELECT 'gold_inventory_reconciliation_ledger', 'total-on-hand-inventory', CAST(sum(shelf_qty + backroom_qty) AS DOUBLE) FROM positions
UNION ALL SELECT 'gold_inventory_reconciliation_ledger', 'inventory-cover-hours',
       round(CAST(sum(shelf_qty + backroom_qty) AS DOUBLE) / (sum(daily_units) / 12e0), 4) FROM positions
UNION ALL SELECT 'gold_inventory_reconciliation_ledger', 'shelf-stock-ratio',
       round(CAST(sum(shelf_qty) AS DOUBLE) / CAST(sum(shelf_qty + backroom_qty) AS DOUBLE) * 100e0, 4) FROM positions
UNION ALL SELECT 'pos_anomaly_alerts', 'cashier-override-rate',
       round(count(*) FILTER (alert_type = 'cashier_promo_abuse') / CAST(count(*) AS DOUBLE), 4) FROM alerts
UNION ALL SELECT 'warranty_generic_sections_extracted', 'warranty-policy-duration', round(avg(p_size), 4) FROM part""",
)
def glossary_metrics(spark, sf_dir):
    pos = positions(spark, sf_dir).withColumnRenamed("daily_units", "total_units_sold_intraday")
    return metrics.evaluate(
        {
            "pos_transactions_gold": V.gold_checkouts(spark, sf_dir),
            "gold_inventory_reconciliation_ledger": pos,
            "pos_anomaly_alerts": V.alerts(spark, sf_dir),
            "warranty_generic_sections_extracted": V.policies(spark, sf_dir),
        }
    )


@query(
    "bound_sql",
    "SELECT event_type, count(*) AS events, max(value) AS largest FROM events WHERE value >= 25.5 AND event_type <> 'x''; --' GROUP BY 1",
)
def bound_sql(spark, sf_dir):
    """A query text with bound values, one of which would break it if it were pasted in."""
    V.table(spark, sf_dir, "events").createOrReplaceTempView("bound_events")
    text = "SELECT event_type, count(*) AS events, max(value) AS largest FROM bound_events WHERE value >= :low AND event_type <> :odd GROUP BY 1"
    return bind(spark, text, low=25.5, odd="x'; --")
