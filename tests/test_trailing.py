import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from aislewise.operators import sales
from aislewise.streaming import compaction, jobs, late, trailing
from tests.test_streaming import event, write_lines

T0 = dt.datetime(2026, 3, 10, 12)
SCHEMA = (
    "transaction_id string, event_ts timestamp, store_id string, cashier_id string, subtotal_amount decimal(18,2), "
    "discount_amount decimal(18,4), promo_code_applied string, manual_discount_flag boolean"
)


def fed(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def checkout(n, seconds, cashier="C1", override=False, promo=None, discount="1.0"):
    return (f"t{n}", T0 + dt.timedelta(seconds=seconds), "S1", cashier, D("10.00"), D(discount), promo, override)


def watch(spark, folder, lake):
    silver = spark.readStream.schema(SCHEMA).parquet(folder)
    trailing.trailing_watch(silver, lake, partitions=2).awaitTermination()


def naive(rows):
    """Every end at which a pane enters or leaves, with the events of the hour before it."""
    out = {}
    for cashier in {r[3] for r in rows}:
        own = [r for r in rows if r[3] == cashier]
        ends = {int((r[1] - T0).total_seconds() // 10 * 10 + 10) for r in own}
        for end in ends | {e + 3600 for e in ends}:
            inside = [r for r in own if end - 3600 <= (r[1] - T0).total_seconds() < end]
            out[cashier, end] = (len(inside), sum(r[7] for r in inside), float(sum(r[5] for r in inside)), end in ends)
    return out


def test_trailing_hour_falls_to_zero_over_restarts(spark, tmp_path):
    folder, lake = str(tmp_path / "in"), jobs.Lake(str(tmp_path / "lake"))
    seconds = [0, 3, 9.5, 10, 1800, 3595, 3605, 7300, 9000]
    rows = [checkout(i, s, f"C{i % 2}", i != 3, "P" if i % 2 == 0 else None, str(20 * i)) for i, s in enumerate(seconds)]
    for part in (rows[:4], rows[4:6], rows[6:8], rows[8:]):
        fed(spark, folder, part)
        watch(spark, folder, lake)
    fed(spark, folder, [checkout(100, 9000 + 7200, "clock")])
    watch(spark, folder, lake)
    got = spark.read.parquet(lake.path("trailing")).where("cashier_id <> 'clock'")
    got = got.withColumn("end", F.unix_seconds("window_end") - int(T0.replace(tzinfo=dt.timezone.utc).timestamp())).collect()
    told = {
        (r.cashier_id, r.end): (r.cashier_1h_txn_count, r.cashier_1h_manual_override_count, r.cashier_1h_total_discount_usd, r.entered)
        for r in got
    }
    assert len(told) == len(got) and told == naive(rows)
    last = max((r for r in got if r.cashier_id == "C0"), key=lambda r: r.end)
    assert last.cashier_1h_txn_count == 0 and last.last_event_ts is None and last.audit_status == "clear"
    newest = min((r for r in got if r.cashier_id == "C0"), key=lambda r: r.row_key)
    assert newest.end == last.end
    alerts = spark.read.parquet(lake.path("trailing_alerts"))
    assert alerts.count() == alerts.select("alert_id").distinct().count() > 0


def test_late_rows_are_kept_and_counted(spark, tmp_path):
    source, lake = tmp_path / "in", jobs.Lake(str(tmp_path / "lake"))
    batches = [
        [event(1, T0), event(2, T0 + dt.timedelta(hours=1)), "{"],
        [event(3, T0 + dt.timedelta(minutes=49)), event(4, T0 + dt.timedelta(minutes=50)), event(5, T0), '{"store_id": "S"}'],
        [event(6, T0 + dt.timedelta(hours=3)), event(7, T0 + dt.timedelta(minutes=55))],
        [event(8, T0 + dt.timedelta(hours=2))],
    ]
    for k, lines in enumerate(batches):
        write_lines(source, f"{k}.json", lines)
        raw = spark.readStream.format("text").load(str(source))
        late.intake(raw, lake).awaitTermination()
    counts = spark.read.parquet(lake.path("intake_counts")).orderBy("batch_id").collect()
    assert [(r.on_time, r.late, r.rejected) for r in counts] == [(2, 0, 1), (1, 2, 1), (2, 0, 0), (0, 1, 0)]
    assert {r[0] for r in spark.read.parquet(lake.path("late")).select("transaction_id").collect()} == {"t3", "t5", "t8"}
    assert spark.read.parquet(lake.path("silver")).count() == 5


def table_rows(spark, path):
    return sorted(tuple(r) for r in compaction.current(spark, path).select("k", "v", "ts").collect())


def test_compaction_survives_being_stopped(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    as_of = F.lit(dt.datetime(2026, 3, 10))

    def write(batch):
        ts = F.timestamp_seconds(F.lit(1_773_000_000) + F.col("id") * 60 + batch)
        rows = spark.range(40).select((F.col("id") % 8).alias("k"), (F.col("id") + 100 * batch).alias("v"), ts.alias("ts"))
        jobs.write_batch(rows.withColumn("salt", F.lpad((F.col("k") % 2).cast("string"), 2, "0")), path, batch, ("salt",))

    def rewrite(rows):
        return sales.compact(rows, ["k"], "ts", as_of, 30)

    def expected():
        every = spark.read.parquet(path)
        return sorted(tuple(r) for r in rewrite(every.select("k", "v", "ts")).collect())

    for batch in range(3):
        write(batch)
    want = expected()
    with monkeypatch.context() as m:
        m.setattr(compaction, "clean", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        try:
            compaction.compact_table(spark, path, rewrite)
        except RuntimeError:
            pass
    # The first bucket has a generation and all its batches, the second only its batches.
    assert compaction.newest_generations(spark, path) == {"00": 2}
    write(3)  # a batch that comes meanwhile
    compaction.compact_table(spark, path, rewrite)
    got = table_rows(spark, path)
    assert len(got) == 8 and {r[0] for r in got} == {r[0] for r in want} and max(r[1] for r in got) == 339
    files = [p for root in (path, compaction.generations(path)) for p in __import__("pathlib").Path(root).rglob("*.parquet")]
    assert len(files) == 2
    # A generation without its success mark is none.
    write(4)
    before = table_rows(spark, path)
    (tmp_path / "t_generations" / "salt=00" / "upto=9").mkdir()
    assert table_rows(spark, path) == before
    compaction.compact_table(spark, path, rewrite)
    assert len(table_rows(spark, path)) == 8
