import datetime as dt
import json

from pyspark.sql import functions as F

from aislewise.sources import sinks, streams, tables
from aislewise.streaming import events, jobs, scoring, windows

T0 = dt.datetime(2026, 3, 10, 12)


def event(n, at, cashier="CASH_1", override=False, promo=None, subtotal=100.0, discount=0.0, **more):
    body = {
        "transaction_id": f"t{n}", "event_timestamp": at.strftime("%Y-%m-%d %H:%M:%S"), "store_id": "STORE_001",
        "cashier_id": cashier, "subtotal_amount": subtotal, "discount_amount": discount,
        "manual_discount_flag": override, "promo_code_applied": promo,
    }
    return json.dumps({**body, **more})


def write_lines(path, name, lines):
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join(lines) + "\n")


def checkouts(spark, data):
    return spark.createDataFrame(
        data, "transaction_id string, event_ts timestamp, store_id string, cashier_id string, subtotal_amount decimal(18,2), "
        "discount_amount decimal(18,4), promo_code_applied string, manual_discount_flag boolean",
    )


def sample(spark):
    from decimal import Decimal as D

    offsets = [0, 3, 9.999999, 10, 1800, 3590, 3599.5, 3600, 3605, 7300, 90000]
    return checkouts(
        spark,
        [
            (f"t{i}", T0 + dt.timedelta(seconds=s), "S1", f"C{i % 2}", D("10.00"), D(i), "P" if i % 3 == 0 else None, i % 2 == 0)
            for i, s in enumerate(offsets)
        ],
    )


def naive(df):
    """Copy every event to its windows, then group."""
    rows = {}
    for r in df.collect():
        start = int(r.event_ts.replace(tzinfo=dt.timezone.utc).timestamp()) // 10 * 10
        for n in range(1, 361):
            rows.setdefault((r.cashier_id, start + 10 * n), []).append(r)
    return rows


def test_sliding_windows_equal_copying_events(spark):
    df = sample(spark)
    want = naive(df)
    got = windows.sliding_metrics(df).withColumn("end", F.unix_seconds("window_end")).collect()
    assert {(r.cashier_id, r.end) for r in got} == set(want)
    for r in got:
        inside = want[(r.cashier_id, r.end)]
        assert r.cashier_1h_txn_count == len(inside)
        assert r.cashier_1h_manual_override_count == sum(e.manual_discount_flag for e in inside)
        assert r.cashier_1h_total_discount_usd == float(sum(e.discount_amount for e in inside))
        assert r.last_event_ts == max(e.event_ts for e in inside)


def test_rolling_rows_are_the_sliding_rows_at_event_panes(spark):
    df = sample(spark)
    every = windows.sliding_metrics(df)
    rolled = windows.rolling_metrics(df)
    assert rolled.count() < every.count()
    assert rolled.exceptAll(every).count() == 0


def test_no_cashier_history_in_one_window_group(spark):
    df = spark.range(20000).select(
        F.concat(F.lit("t"), "id").alias("transaction_id"),
        F.timestamp_seconds(F.lit(1773100800) + F.col("id") * 20).alias("event_ts"),
        F.lit("S").alias("store_id"), F.lit("C").alias("cashier_id"), F.lit(1).cast("decimal(18,2)").alias("subtotal_amount"),
        F.lit(0).cast("decimal(18,4)").alias("discount_amount"), F.lit(None).cast("string").alias("promo_code_applied"),
        F.lit(True).alias("manual_discount_flag"),
    )
    out = windows.rolling_metrics(df)
    assert out.agg(F.max("cashier_1h_txn_count")).first()[0] == 180
    assert "hour" in [l for l in out._jdf.queryExecution().executedPlan().toString().splitlines() if "Window [" in l][0]


def test_hourly_metrics(spark):
    got = {(r.cashier_id, r.window_start): r for r in windows.hourly_metrics(sample(spark)).collect()}
    assert got[("C0", T0)].txn_count == 4 and got[("C0", T0)].override_count == 4
    assert got[("C1", T0)].override_amount == 0.0
    assert got[("C0", T0)].row_key.endswith("#WIN#2026031012")


def test_scores_and_fallback_rule(spark):
    m = spark.createDataFrame([(4, 60.0, 0.5), (4, 50.0, 0.5), (0, 0.0, 0.0)], "cashier_1h_manual_override_count long, cashier_1h_total_discount_usd double, cashier_1h_promo_rate double")
    model = scoring.score_cashiers(m).collect()
    assert all(0 <= r.risk_score <= 1 and r.detection_mode == scoring.MODEL for r in model)
    assert [r.audit_status for r in model] == ["review", "review", "clear"]
    rule = scoring.score_cashiers(m, scorer=None).collect()
    assert [(r.risk_score, r.audit_status) for r in rule] == [(1.0, "review"), (0.0, "clear"), (0.0, "clear")]
    assert rule[0].detection_mode == scoring.HEURISTIC


def test_alert_ids_repeat_on_replay(spark):
    df = sample(spark).withColumn("discount_amount", F.lit(9.5).cast("decimal(18,4)"))
    a = sorted(r.alert_id for r in scoring.order_alerts(df, 0.5).collect())
    b = sorted(r.alert_id for r in scoring.order_alerts(df.repartition(3), 0.5).collect())
    assert a == b and len(set(a)) == len(a) and all(x.startswith("ALT-ANOMALY-") for x in a)


def test_parse_rejects_with_reason(spark):
    lines = [
        event(1, T0), '{"transaction_id": ', event(2, T0, transaction_id=None), event(3, T0, store_id=None),
        event(4, T0, event_timestamp="soon"), event(5, dt.datetime(2026, 3, 10, 3, 59)),
    ]
    out = events.parse_events(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert [r.reject_reason for r in out.collect()] == [None, "MALFORMED_JSON", "NO_TRANSACTION_ID", "NO_STORE_ID", "BAD_EVENT_TIME", None]
    assert str(out.collect()[5].business_date) == "2026-03-09"
    assert events.accepted(out).count() == 2 and events.rejected(out).count() == 4


def test_once_in_batch(spark):
    df = spark.createDataFrame([("a", T0), ("a", T0 + dt.timedelta(1)), ("b", T0)], "transaction_id string, event_ts timestamp")
    got = {r.transaction_id: r.event_ts for r in events.once(df).collect()}
    assert got == {"a": T0 + dt.timedelta(1), "b": T0}


def test_streams_end_to_end(spark, tmp_path):
    source, lake = tmp_path / "in", jobs.Lake(str(tmp_path / "lake"))
    first = [event(i, T0 + dt.timedelta(seconds=30 * i), override=True, discount=20.0) for i in range(10)]
    write_lines(source, "a.json", [*first, first[0], "broken", event(99, T0, store_id=None)])
    raw = streams.text_events(spark, str(source))
    jobs.ingest(raw, lake).awaitTermination()
    assert spark.read.parquet(lake.path("silver")).count() == 11
    assert spark.read.parquet(lake.path("dead_letter")).count() == 2

    def watch():
        jobs.cashier_watch(jobs.silver_changes(spark, lake, 1), lake).awaitTermination()

    watch()
    # A later event moves the watermark and closes the earlier panes; one more is far too late.
    later = T0 + dt.timedelta(minutes=40)
    write_lines(source, "b.json", [event(200, later), event(201, later + dt.timedelta(hours=2))])
    jobs.ingest(raw, lake).awaitTermination()
    watch()
    write_lines(source, "c.json", [event(300, T0), event(301, later + dt.timedelta(hours=4))])
    jobs.ingest(raw, lake).awaitTermination()
    watch()
    serving = jobs.serving_table(spark, lake)
    got = {r.window_end: r for r in serving.collect()}
    silver = spark.read.parquet(lake.path("silver")).filter("transaction_id NOT IN ('t300')")
    want = {r.window_end: r for r in windows.rolling_metrics(events.once(silver)).collect()}
    assert set(got) and set(got) <= set(want)
    assert {T0 + dt.timedelta(seconds=30 * i + 10) for i in range(10)} <= set(got)
    assert later + dt.timedelta(seconds=10) in got
    for end, r in got.items():
        for c in ("cashier_1h_txn_count", "cashier_1h_manual_override_count", "cashier_1h_total_discount_usd"):
            assert r[c] == want[end][c], (end, c)
    assert got[later + dt.timedelta(seconds=10)].cashier_1h_txn_count == 11
    alerts = spark.read.parquet(lake.path("alerts"))
    assert alerts.count() == alerts.select("alert_id").distinct().count() > 0
    jobs.order_watch(jobs.silver_changes(spark, lake), lake, threshold=0.0).awaitTermination()
    orders = spark.read.parquet(lake.path("alerts_orders"))
    assert orders.count() == orders.select("alert_id").distinct().count() > 0
    assert orders.count() == spark.read.parquet(lake.path("silver")).select("transaction_id").distinct().count()


def test_batch_writes_replace_themselves(spark, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        jobs.write_batch(spark.range(5), path, 7)
    jobs.write_batch(spark.range(3), path, 8)
    assert spark.read.parquet(path).count() == 8


def test_hourly_stream_writes_few_files_a_bucket(spark, tmp_path):
    source, lake = str(tmp_path / "in"), jobs.Lake(str(tmp_path / "lake"))
    rows = spark.range(600).select(
        F.concat(F.lit("t"), "id").alias("transaction_id"), F.timestamp_seconds(F.lit(1773100800) + F.col("id") * 60).alias("event_ts"),
        F.lit("S").alias("store_id"), F.concat(F.lit("C"), F.col("id") % 40).alias("cashier_id"),
        F.lit(10).cast("decimal(18,2)").alias("subtotal_amount"), F.col("id").cast("decimal(18,4)").alias("discount_amount"),
        F.lit(None).cast("string").alias("promo_code_applied"), (F.col("id") % 3 == 0).alias("manual_discount_flag"),
    )
    closing = rows.limit(1).withColumn("transaction_id", F.lit("last")).withColumn("event_ts", F.lit(T0 + dt.timedelta(days=9)))
    for fed in (rows.where("event_ts < '2026-03-10 05:30:00'"), rows.where("event_ts >= '2026-03-10 05:30:00'"), closing):
        fed.write.mode("append").parquet(source)
        query = jobs.hourly_watch(streams.table_changes(spark, source, rows.schema), lake, partitions=3)
        query.awaitTermination()
        state = [s for p in query.recentProgress for s in p["stateOperators"]]
        assert state and {s["numShufflePartitions"] for s in state} == {3}
        assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    got = spark.read.parquet(lake.path("hourly")).drop("salt", "batch_id")
    want = windows.hourly_metrics(rows)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
    files = [p.parent for p in (tmp_path / "lake" / "hourly").rglob("*.parquet")]
    assert len(files) == len(set(files))


def test_batch_partitions_without_adaptive_execution(spark, tmp_path):
    rows = spark.range(4000, numPartitions=8).select("id", (F.col("id") % 3).alias("day"), F.array("id").alias("items"))
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    for adaptive, partitions, files_a_day in (("false", "4", 1), ("false", "40", 3), ("true", "4", 1)):
        path = tmp_path / f"{adaptive}_{partitions}"
        try:
            spark.conf.set("spark.sql.adaptive.enabled", adaptive)
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            for _ in range(2):
                jobs.write_batch(rows, str(path), 0, ("day",))
        finally:
            for k, v in kept.items():
                spark.conf.set(k, v)
        # A large day is several tasks' work, and no day is a file of every task's.
        assert [len([*(path / f"day={d}").rglob("*.parquet")]) for d in range(3)] == [files_a_day] * 3
        assert spark.read.parquet(str(path)).select("id", "day", "items").exceptAll(rows).count() == 0
        assert spark.read.parquet(str(path)).count() == 4000


def test_sources_and_sinks(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.range(5).write.parquet(path)
    df = tables.read_table(spark, ["missing_table", str(tmp_path / "none.parquet"), path], ["id"], F.col("id") > 2)
    assert df.count() == 2
    try:
        tables.read_table(spark, ["missing_table"])
        raise AssertionError("a missing table was read")
    except RuntimeError as e:
        assert "missing_table" in str(e)
    assert tables.canonical_name("my-project:data.t") == "`my-project`.data.t"
    assert tables.canonical_name("t", "cat.ns") == "cat.ns.t"
    assert tables.is_readable(df) and not tables.is_readable(df.limit(0))
    assert tables.bound_sql(spark, "SELECT :x AS v", x="a' OR 1=1").first().v == "a' OR 1=1"
    keys = spark.createDataFrame([("A_1#2",), ("A_1#1",), ("AX1#1",)], "row_key string")
    assert [r.row_key for r in tables.prefix_scan(keys, "A_1", 1).collect()] == ["A_1#1"]
    sinks.create_table_as(spark.range(3), "ctas_t")
    sinks.insert_select(spark.range(10, 12), "ctas_t")
    assert spark.table("ctas_t").count() == 5
    sinks.publish_view(spark.table("ctas_t"), "v_t")
    assert spark.sql("SELECT count(*) AS n FROM v_t").first().n == 5
    new = str(tmp_path / "grow")
    sinks.append_new(spark.range(3), new, "id")
    sinks.append_new(spark.range(5), new, "id")
    assert sorted(r.id for r in spark.read.parquet(new).collect()) == [0, 1, 2, 3, 4]
    assert sinks.write_first(spark.range(1), ["bad..name", str(tmp_path / "w")]) == str(tmp_path / "w")
    assert sinks.write_first(spark.range(1), ["x"], dry_run=True) is None


def test_read_sources_filters_sales_only(spark, tmp_path):
    for name in ("pos", "inv", "stores"):
        spark.createDataFrame([("2026-01-01",), ("2026-01-02",)], "business_date string").write.parquet(str(tmp_path / name))
    paths = [[str(tmp_path / n)] for n in ("pos", "inv", "stores")]
    s = tables.read_sources(spark, *paths, start_date="2026-01-02", until_date="all")
    assert (s.pos.count(), s.inventory.count()) == (1, 2)
    assert "PushedFilters: [IsNotNull(business_date), GreaterThanOrEqual(business_date,2026-01-02)]" in s.pos._jdf.queryExecution().toString()


def test_audit_raises(spark, tmp_path):
    path = str(tmp_path / "d")
    df = spark.createDataFrame([("2026-01-01", 1), ("2026-01-02", 2)], "business_date string, v int").withColumn("business_date", F.to_date("business_date"))
    written = sinks.write_dated(df, path)
    assert written["n_rows"] == 2
    sinks.audit_written(spark, path, df.columns, written)
    try:
        sinks.audit_written(spark, path, df.columns, {**written, "checksum": 0})
        raise AssertionError("a wrong checksum passed")
    except sinks.AuditError:
        pass
