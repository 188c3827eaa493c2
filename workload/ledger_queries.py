"""Ledger, its slots and the reports on it. Point-of-sale data: the whole events table."""

import uuid

from pyspark.sql import functions as F

from aislewise.operators import ledger as L
from aislewise.operators.places import places
from aislewise.plans import nightly
from aislewise.session import shared_dir
from aislewise.sources.tables import Sources
from aislewise.session import cut_lineage
from workload import views as V
from workload.registry import query

SETTINGS = L.LedgerSettings()


def _double(x: float) -> str:
    return f"{x!r}e0"


HOUR_SHAPE_SQL = "[" + ", ".join(_double(x) for x in SETTINGS.hour_shape()) + "]"

SALES_SQL = """
sales AS (
  SELECT 'TXN-' || event_id AS transaction_id, CAST(ts AS DATE) AS business_date,
         printf('STORE_%03d', user_id) AS store_id, event_type AS item_id,
         CAST(json_extract(props, '$.k') AS BIGINT) AS qty, CAST(value AS DECIMAL(28, 9)) AS amount
  FROM events
),
revenue AS (
  SELECT business_date, store_id, CAST(round(sum(amount), 2) AS DOUBLE) AS intraday_gross_revenue_usd
  FROM sales GROUP BY ALL
),
units AS (
  SELECT business_date, store_id, item_id, CAST(greatest(sum(qty), 0) AS DOUBLE) AS daily_units
  FROM sales GROUP BY ALL
)"""

INVENTORY_SQL = """
inventory AS (
  SELECT DISTINCT printf('STORE_%03d', user_id) AS store_id, event_type AS item_id,
         CAST(length(event_type) + 0.5 AS DOUBLE) AS unit_price_usd,
         (user_id * 11 + length(event_type)) % 90 AS opening_qty,
         (user_id * 7 + length(event_type) * 3) % 40 AS shelf_qty,
         (user_id * 5 + length(event_type)) % 60 AS backroom_qty
  FROM events
),
stores AS (
  SELECT printf('STORE_%03d', s_suppkey) AS store_id, s_name AS store_name, n_name AS city, r_name AS region
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

POSITIONS_SQL = f"""{SALES_SQL}, {INVENTORY_SQL},
positions AS (
  SELECT d.business_date, i.store_id, s.store_name, s.city, i.item_id, i.unit_price_usd, i.opening_qty,
         i.shelf_qty, i.backroom_qty, coalesce(r.intraday_gross_revenue_usd, 0e0) AS intraday_gross_revenue_usd,
         CAST(i.shelf_qty + i.backroom_qty AS DOUBLE) AS on_hand, coalesce(u.daily_units, 0e0) AS daily_units
  FROM (SELECT DISTINCT business_date FROM sales) d CROSS JOIN inventory i
  JOIN stores s USING (store_id)
  LEFT JOIN revenue r ON r.business_date = d.business_date AND r.store_id = i.store_id
  LEFT JOIN units u ON u.business_date = d.business_date AND u.store_id = i.store_id AND u.item_id = i.item_id
)"""

LEDGER_CTE = f"""{POSITIONS_SQL},
slots AS (
  SELECT list_transform(range(288), lambda i: {{'b': ({HOUR_SHAPE_SQL})[CAST(i // 12 AS BIGINT) + 1], 'n': 0}}) AS w
),
burn AS (
  SELECT p.*, list_reduce(w, lambda acc, x: {{
      'b': acc.b + daily_units * x.b / 288e0,
      'n': acc.n + CASE WHEN greatest(0e0, on_hand - (acc.b + daily_units * x.b / 288e0)) > 3e0 THEN 1 ELSE 0 END
    }}, {{'b': 0e0, 'n': 0}}).n AS stocked
  FROM positions p, slots
),
cover AS (
  SELECT *, round(coalesce(CASE WHEN stocked < 288 THEN stocked * {_double(5 / 60)} END,
                           CASE WHEN daily_units > 0 THEN on_hand / (daily_units / 24e0) END), 1)
            AS est_cover_hours_remaining
  FROM burn
),
ledger AS (
  SELECT business_date, store_id, store_name, city, item_id, unit_price_usd, opening_qty, shelf_qty, backroom_qty,
         intraday_gross_revenue_usd, est_cover_hours_remaining,
         CASE WHEN est_cover_hours_remaining <= 6 THEN '{L.STATUS_CRITICAL}'
              WHEN est_cover_hours_remaining <= 12 THEN '{L.STATUS_MONITOR}'
              ELSE '{L.STATUS_NORMAL}' END AS reconciliation_status
  FROM cover
)"""
LEDGER_SQL = f"WITH {LEDGER_CTE} SELECT * FROM ledger"


def positions(spark, sf_dir, per_task=None):
    silver = L.silver_sales(V.bronze_events(spark, sf_dir), SETTINGS)
    return L.positions(V.inventory(spark, sf_dir), V.stores(spark, sf_dir), silver, per_task)


def ledger(spark, sf_dir, form="closed"):
    per_task = L.window_positions(SETTINGS) if form == "window" else None
    return L.ledger(positions(spark, sf_dir, per_task), SETTINGS, form)


@query("position_grid", f"WITH {POSITIONS_SQL} SELECT * FROM positions")
def position_grid(spark, sf_dir):
    return positions(spark, sf_dir)


@query("ledger_closed_form", LEDGER_SQL)
def ledger_closed_form(spark, sf_dir):
    return ledger(spark, sf_dir)


@query("ledger_fold", LEDGER_SQL)
def ledger_fold(spark, sf_dir):
    return ledger(spark, sf_dir, "fold")


@query("ledger_window", LEDGER_SQL)
def ledger_window(spark, sf_dir):
    return ledger(spark, sf_dir, "window")


@query(
    "ledger_status",
    f"""WITH {LEDGER_CTE}
SELECT reconciliation_status, count(*) AS positions,
       CAST(round(sum(CAST(intraday_gross_revenue_usd AS DECIMAL(28, 9))), 2) AS DOUBLE) AS revenue_usd,
       round(CAST(sum(CAST(est_cover_hours_remaining AS DECIMAL(28, 9))) AS DOUBLE)
             / count(est_cover_hours_remaining), 1) AS avg_cover_hours
FROM ledger GROUP BY 1""",
)
def ledger_status(spark, sf_dir):
    return L.status_summary(ledger(spark, sf_dir))


@query(
    "stockout_top20",
    f"""WITH {LEDGER_CTE}
SELECT business_date, store_id, store_name, city, item_id, shelf_qty, backroom_qty,
       shelf_qty + backroom_qty AS total_on_hand_inventory, intraday_gross_revenue_usd,
       est_cover_hours_remaining, reconciliation_status
FROM ledger WHERE est_cover_hours_remaining < 20
ORDER BY intraday_gross_revenue_usd DESC, est_cover_hours_remaining, business_date, store_id, item_id LIMIT 20""",
)
def stockout_top20(spark, sf_dir):
    return L.stockout_risk(ledger(spark, sf_dir))


@query(
    "revenue_cover_quadrants",
    f"""WITH {LEDGER_CTE}, known AS (
  SELECT *, intraday_gross_revenue_usd >= 100 AS high, est_cover_hours_remaining >= 24 AS long
  FROM ledger)
SELECT CASE WHEN est_cover_hours_remaining IS NULL THEN 'UNKNOWN_COVER' WHEN high AND long THEN 'HIGH_REVENUE_LONG_COVER' WHEN high THEN 'HIGH_REVENUE_SHORT_COVER'
            WHEN long THEN 'LOW_REVENUE_LONG_COVER' ELSE 'LOW_REVENUE_SHORT_COVER' END AS quadrant,
       count(*) AS positions, count(DISTINCT store_id) AS stores
FROM known GROUP BY 1""",
)
def revenue_cover_quadrants(spark, sf_dir):
    return L.revenue_cover_quadrants(ledger(spark, sf_dir), F.lit(100.0), F.lit(24.0))


@query(
    "quadrants_by_percentile",
    f"""WITH {LEDGER_CTE}, splits AS (
  SELECT quantile_disc(intraday_gross_revenue_usd, 0.75) AS high_at, quantile_disc(intraday_gross_revenue_usd, 0.25) AS low_at,
         quantile_disc(est_cover_hours_remaining, 0.75) AS long_at, quantile_disc(est_cover_hours_remaining, 0.25) AS short_at
  FROM ledger)
SELECT CASE WHEN intraday_gross_revenue_usd >= high_at AND est_cover_hours_remaining >= long_at THEN 'HIGH_REVENUE_LONG_COVER'
            WHEN intraday_gross_revenue_usd <= low_at AND est_cover_hours_remaining <= short_at THEN 'LOW_REVENUE_SHORT_COVER'
            ELSE 'BETWEEN' END AS quadrant, high_at, low_at, long_at, short_at,
       count(*) AS positions, count(DISTINCT store_id) AS stores
FROM ledger, splits GROUP BY ALL""",
)
def quadrants_by_percentile(spark, sf_dir):
    """Positions of the highest quarter of revenue and of cover, and of the lowest of both, at exact percentiles."""
    return L.percentile_quadrants(cut_lineage(ledger(spark, sf_dir)), 0.25, 0.75)


@query(
    "demand_by_hour",
    f"""WITH {POSITIONS_SQL},
hours AS (SELECT unnest(range(24)) AS hour)
SELECT business_date, store_id, CAST(hour AS INTEGER) AS hour, count(*) * 12 AS slots,
       round(sum(daily_units * ({HOUR_SHAPE_SQL})[hour + 1] / 24e0), 6) AS expected_units
FROM positions, hours GROUP BY ALL""",
)
def demand_by_hour(spark, sf_dir):
    """Time fabric and demand curve, totalled per store and hour."""
    fabric = L.slot_fabric(positions(spark, sf_dir), SETTINGS)
    return fabric.groupBy("business_date", "store_id", "hour").agg(
        F.count(F.lit(1)).alias("slots"), F.round(F.sum("slot_demand"), 6).alias("expected_units")
    )


@query(
    "audit_hash",
    f"""WITH {POSITIONS_SQL},
hashes AS (
  SELECT business_date, store_id,
         sha256(business_date || '~' || store_id || '~' || item_id || '|' || slot || '#s0') AS h
  FROM positions, (SELECT unnest(range(288)) AS slot)
)
SELECT business_date, store_id, count(*) AS slots, min(h) AS first_hash, max(h) AS last_hash
FROM hashes GROUP BY ALL""",
)
def audit_hash(spark, sf_dir):
    """A digest of every position and slot, reported per store and day. A position's digests are reduced in its own row: Spark
    sorts rows to find the least text of a group, and the slots are hundreds of times more rows than the positions."""
    hashes = L.audit_hashes(L.slot_fabric(positions(spark, sf_dir), SETTINGS, nested=True), SETTINGS)
    ends = hashes.select(
        "business_date", "store_id", F.size("audit_hash").alias("n"), F.array_min("audit_hash").alias("least"), F.array_max("audit_hash").alias("most")
    )
    # Dealt out first: otherwise the sort below the aggregation would hold the arrays.
    return ends.repartition("business_date", "store_id").groupBy("business_date", "store_id").agg(
        F.sum("n").alias("slots"), F.min("least").alias("first_hash"), F.max("most").alias("last_hash")
    )


DATES_SQL = "SELECT min(business_date) + 1 AS low, max(business_date) - 1 AS high FROM positions"


@query(
    "ledger_date_range",
    f"WITH {LEDGER_CTE}, ends AS ({DATES_SQL}) SELECT ledger.* FROM ledger, ends WHERE business_date BETWEEN low AND high",
)
def ledger_date_range(spark, sf_dir):
    """The ledger with both ends of its date range set: all days but the first and the last."""
    day = F.col("ts").cast("date")
    low, high = V.table(spark, sf_dir, "events").agg(F.date_add(F.min(day), 1), F.date_sub(F.max(day), 1)).first()
    settings = L.LedgerSettings(start_date=str(low), until_date=str(high))
    silver = L.silver_sales(V.bronze_events(spark, sf_dir), settings)
    return L.ledger(L.positions(V.inventory(spark, sf_dir), V.stores(spark, sf_dir), silver), settings)


@query("ledger_written", LEDGER_SQL)
def ledger_written(spark, sf_dir):
    """The nightly job: staged, compared with its inputs, published, and read back."""
    target = f"{shared_dir(spark)}/ledger-{uuid.uuid4().hex}"
    sources = Sources(V.bronze_events(spark, sf_dir), V.inventory(spark, sf_dir), V.stores(spark, sf_dir))
    nightly.run(spark, sources, target, SETTINGS)
    return spark.read.parquet(target).select(*L.LEDGER_COLUMNS)


@query(
    "ledger_places",
    f"""WITH {LEDGER_CTE} SELECT business_date, store_id, item_id, row_number() OVER (ORDER BY business_date DESC,
est_cover_hours_remaining ASC NULLS LAST, store_id, item_id) AS place FROM ledger""",
)
def ledger_places(spark, sf_dir):
    """The place of every position in the whole reading order: newest day first."""
    return places(L.display_order(ledger(spark, sf_dir)), "business_date", "store_id", "item_id")


@query(
    "ordered_ledger",
    f"""WITH {LEDGER_CTE} SELECT store_id, item_id, row_number() OVER (PARTITION BY business_date
ORDER BY est_cover_hours_remaining ASC NULLS LAST, store_id, item_id) AS place, business_date FROM ledger""",
)
def ordered_ledger(spark, sf_dir):
    """The place of every position in its day's reading order: shortest cover first, unknown cover last."""
    whole = ledger_places(spark, sf_dir)
    first = whole.groupBy("business_date").agg(F.min("place").alias("first"))
    day = whole.join(first, "business_date")
    return day.select("business_date", "store_id", "item_id", (F.col("place") - F.col("first") + 1).alias("place"))
