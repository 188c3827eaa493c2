import datetime as dt

from pyspark.sql import functions as F

from aislewise.operators import dedup, metrics, sales, warranty

T0 = dt.datetime(2026, 3, 10, 12)


def test_latest_per_key_orders_nulls_last_and_is_total(spark):
    df = spark.createDataFrame(
        [("a", None, "x"), ("a", "1", "y"), ("a", "1", "z"), ("b", None, "q"), ("c", "2", "k"), ("c", "2", "k")],
        "id string, at string, v string",
    )
    got = {r.id: (r["at"], r.v) for r in dedup.latest_per_key(df, ["id"], ["at"]).collect()}
    assert got == {"a": ("1", "z"), "b": (None, "q"), "c": ("2", "k")}


def test_latest_per_key_combines_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = dedup.latest_per_key(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_duplicate_report(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), ("b", 2), ("b", 2), ("c", 1)], "id string, v int")
    assert rows(dedup.duplicate_report(df, ["id"], name="t")) == [
        {"table_name": "t", "n_rows": 6, "n_keys": 3, "surplus_rows": 3, "keys_seen_twice": 1,
         "keys_seen_3_or_more": 1, "keys_with_conflicts": 1}
    ]


def checkouts(spark):
    h = dt.timedelta(hours=1)
    return spark.createDataFrame(
        [
            ("t1", T0 - 0.5 * h, "S1", "C1", True),
            ("t2", T0 - 0.2 * h, "S1", "C1", False),
            ("t3", T0 - 48 * h, "S1", "C1", False),
            ("t4", T0 - 24 * 20 * h, "S1", "C1", True),
            ("t5", T0 - 24 * 40 * h, "S1", "C1", True),
            ("t6", T0 - 2 * h, "S1", "C2", False),
            ("t7", T0 + h, "S1", "C2", True),
        ],
        "transaction_id string, event_ts timestamp, store_id string, cashier_id string, manual_discount_flag boolean",
    )


def test_live_against_baseline(spark):
    got = sales.live_against_baseline(checkouts(spark), F.lit(T0)).collect()
    assert len(got) == 1
    r = got[0]
    assert (r.cashier_id, r.live_txn_count, r.live_override_rate_pct, r.baseline_rate_pct) == ("C1", 2, 50.0, 50.0)
    assert (r.times_baseline, r.difference_pct) == (1.0, 0.0)


def test_override_rates(spark):
    got = {r.cashier_id: r for r in sales.override_rates(checkouts(spark), F.lit(T0)).collect()}
    assert (got["C1"].txn_count_7d, got["C1"].txn_count_30d) == (3, 4)
    assert got["C1"].override_rate_7d_pct == 33.33
    assert got["C2"].override_rate_30d_pct == 0.0


def alerts(spark):
    d = dt.timedelta(days=1)
    rows = [
        ("A1", "S1", "cashier_promo_abuse", "C1", 0.9, T0 - d),
        ("A2", "S1", "cashier_promo_abuse", "C1", 0.5, T0 - 2 * d),
        ("A3", "S1", "cashier_promo_abuse", "C2", 0.99, T0 - d),
        ("A4", "S1", "order_anomaly", "C2", 0.99, T0 - d),
        ("A5", "S2", "cashier_promo_abuse", "C3", 0.99, T0 - 8 * d),
    ]
    return spark.createDataFrame(
        rows, "alert_id string, store_id string, alert_type string, cashier_id string, risk_score double, alert_ts timestamp"
    )


def test_offenders_and_their_log(spark):
    got = sales.offender_ranking(alerts(spark), F.lit(T0)).collect()
    assert [(r.cashier_id, r.alert_count, r.avg_risk_score) for r in got] == [("C1", 2, 0.7), ("C2", 1, 0.99)]
    log = sales.top_offender_log(alerts(spark), checkouts(spark), F.lit(T0), top=3)
    assert [r.transaction_id for r in log.collect()] == ["t5", "t4", "t3"]


def test_alert_rates_and_newest(spark):
    rate = {(r.store_id, str(r.alert_date)): r.promo_override_rate_pct for r in sales.promo_alert_rate(alerts(spark)).collect()}
    assert rate[("S1", "2026-03-09")] == 66.67
    newest = sales.newest_alerts_per_store(alerts(spark), F.lit(T0), hours=48, top=2).collect()
    assert [(r.alert_id, r["rank"]) for r in newest] == [("A1", 1), ("A3", 2)]


def test_compaction(spark):
    df = spark.createDataFrame(
        [("k", T0, 1), ("k", T0 - dt.timedelta(days=3), 2), ("k", T0 - dt.timedelta(days=30), 3), ("j", T0 - dt.timedelta(days=9), 4)],
        "id string, ts timestamp, v int",
    )
    assert [r.v for r in sales.compact(df, ["id"], "ts", F.lit(T0), 7).collect()] == [1]
    assert sorted(r.v for r in sales.compact(df, ["id"], "ts", F.lit(T0), 14, versions=2).collect()) == [1, 2, 4]
    assert sales.compact(df, ["id"], "ts", F.lit(T0), 365, versions=None).count() == 4


def test_available_to_promise(spark):
    df = spark.createDataFrame(
        [("S", "i", T0, 9, 2), ("S", "i", T0 - dt.timedelta(1), 50, 0)],
        "store_id string, item_id string, updated_at timestamp, on_hand_qty int, reserved_qty int",
    )
    assert [r.atp_qty for r in sales.available_to_promise(df).collect()] == [7]


def test_warranty_is_inclusive_and_needs_a_policy(spark):
    tx = spark.createDataFrame(
        [("t1", "c", dt.date(2025, 3, 31), [("p1", 1), ("p9", 2)]), ("t2", "c", dt.date(2025, 2, 28), [("p1", 1)]), ("t3", "c", dt.date(2026, 1, 1), [])],
        "transaction_id string, customer_id string, business_date date, items array<struct<item_id:string,line_seq:int>>",
    )
    policy = spark.createDataFrame([("p1", 12)], "product_id string, warranty_duration_months int")
    lines = warranty.purchase_lines(tx)
    assert lines.count() == 3
    out = warranty.triage(lines, policy, F.lit("2026-03-01").cast("date"))
    assert {r.transaction_id: (r.months_elapsed, r.warranty_status) for r in out.collect()} == {
        "t1": (12, "COVERED"),
        "t2": (13, "EXPIRED"),
    }
    assert [r.transaction_id for r in warranty.latest_purchase(out).collect()] == ["t1"]
    assert warranty.join_coverage(lines, policy).first().value == 1


def test_terms(spark):
    ledger = spark.createDataFrame([(3, 9, 24.0), (1, 3, 0.0)], "shelf_qty int, backroom_qty int, total_units_sold_intraday double")
    got = {r.term: r.value for r in metrics.evaluate({"gold_inventory_reconciliation_ledger": ledger}).collect()}
    assert got == {"total-on-hand-inventory": 16.0, "inventory-cover-hours": 8.0, "shelf-stock-ratio": 25.0}
    hours = ledger.select(metrics.trading_cover_hours().alias("h")).select("h", metrics.cover_risk(F.col("h")).alias("r"))
    assert [tuple(r) for r in hours.collect()] == [(6.0, "CRITICAL_BURN_SPIKE"), (None, None)]
    gold = spark.createDataFrame([(10.0, 2.0, 1.0, 9.0), (5.0, 9.0, 0.0, -4.0)], "subtotal_amount double, discount double, tax_amount double, total double")
    got = metrics.evaluate({"pos_transactions_gold": gold}).first()
    assert (got.term, got.value) == ("net-transaction-revenue", 9.0)
