import datetime as dt
import struct

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aislewise.functions import keys, masks, numbers, text, time


def one(spark, expr, **cols):
    df = spark.createDataFrame([tuple(cols.values()) or (1,)], list(cols) or ["x"]) if cols else spark.range(1)
    return df.select(expr.alias("v")).first().v


def lit(spark, expr):
    return spark.range(1).select(expr.alias("v")).first().v


def test_event_time_and_business_date(spark):
    ts = dt.datetime(2026, 3, 1, 3, 59)
    assert lit(spark, time.event_time(F.lit("2026-03-01 03:59:00"))) == ts
    assert lit(spark, time.event_time(F.lit("2026-03-01T03:59:00Z"))) == ts
    assert lit(spark, time.event_time(F.lit("garbage"))) is None
    assert lit(spark, time.business_date(F.lit("nope"), F.lit(ts))) == dt.date(2026, 3, 1)


def test_business_day_cutoff(spark):
    before, at = F.lit(dt.datetime(2026, 3, 1, 3, 59)), F.lit(dt.datetime(2026, 3, 1, 4, 0))
    assert lit(spark, time.business_day(before)) == dt.date(2026, 2, 28)
    assert lit(spark, time.business_day(at)) == dt.date(2026, 3, 1)
    assert lit(spark, time.business_day(F.lit(dt.datetime(2026, 3, 1, 2, 0)), "Asia/Tokyo")) == dt.date(2026, 3, 1)


def test_month_boundaries_are_not_elapsed_months(spark):
    d = lambda s: F.lit(s).cast("date")
    assert lit(spark, time.month_boundaries(d("2026-02-01"), d("2026-01-31"))) == 1
    assert lit(spark, time.month_boundaries(d("2027-01-01"), d("2026-12-31"))) == 1


def test_reversed_times_sort_newest_first(spark):
    a, b = F.lit(dt.datetime(2026, 1, 1)), F.lit(dt.datetime(2026, 1, 2))
    assert lit(spark, time.reversed_micros(b) < time.reversed_micros(a))
    assert len(lit(spark, time.reversed_millis(a))) == 13
    stamp = F.timestamp_micros(F.lit(1789091634678000))
    assert lit(spark, time.reversed_micros(stamp)) == "9221582945220097807"


def test_names_and_codes(spark):
    assert [lit(spark, text.store_key(F.lit(x))) for x in ("48", "Store 48", "STORE_048", "depot")] == ["STORE_048"] * 3 + ["depot"]
    assert lit(spark, text.cashier_key(F.lit("CASH_1190"))) == "CASH_1190"
    assert lit(spark, text.file_stem(F.lit("gs://b/manuals/T3000.pdf"))) == "T3000"
    assert lit(spark, text.file_stem(F.lit("gs://b/manuals/T3000.txt"))) is None
    assert lit(spark, text.https_link(F.lit("gs://b/x.pdf"), "https://files.example/")) == "https://files.example/b/x.pdf"
    assert lit(spark, text.https_link(F.lit("s3://b/x.pdf"), "https://files.example")) == "s3://b/x.pdf"
    assert lit(spark, text.names_fault(F.lit("saw ERR_NET_404 today")))
    assert not lit(spark, text.names_fault(F.lit("ERR-ABC-404")))
    assert lit(spark, text.trimmed(F.lit("　\t x \n "))) == "x"


def test_keys(spark):
    salt = lit(spark, keys.salt_bucket(F.lit("STORE_041")))
    assert salt in {f"0{c}" for c in "0123456789abcdef"}
    ts = F.lit(dt.datetime(2026, 9, 8, 14, 5))
    assert lit(spark, keys.hourly_key(F.lit("CASH_1190"), ts)).endswith("#CASHIER#CASH_1190#WIN#2026090814")
    assert lit(spark, keys.serving_key(F.lit("STORE_001"), F.lit("CASH_1"), ts)).startswith("STORE_001#CASH_1#")
    assert "#ALERT#" in lit(spark, keys.alert_key(F.lit("STORE_001"), ts))
    assert lit(spark, keys.stock_key(F.lit("STORE_041"), F.lit("p1"))).endswith("#STORE#STORE_041#SKU#p1")


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.integers(-(2**63), 2**63 - 1), st.floats(allow_nan=False)), min_size=1, max_size=20))
def test_cells_round_trip(spark, values):
    df = spark.createDataFrame(values, "n long, x double")
    got = df.select(
        "n",
        "x",
        keys.encode_int64(F.col("n")).alias("bn"),
        keys.encode_float64(F.col("x")).alias("bx"),
    ).select("*", keys.decode_int64(F.col("bn")).alias("n2"), keys.decode_float64(F.col("bx")).alias("x2"))
    for r in got.collect():
        assert bytes(r.bn) == struct.pack(">q", r.n) and r.n2 == r.n
        assert bytes(r.bx) == struct.pack(">d", r.x) and r.x2 == r.x


def test_text_cells(spark):
    assert lit(spark, keys.decode_text(keys.encode_text(F.lit("größe")))) == "größe"


def test_ratios_and_vectors(spark):
    assert lit(spark, numbers.ratio(F.lit(1), F.lit(0))) is None
    a, b = F.array(F.lit(3.0), F.lit(4.0)), F.array(F.lit(4.0), F.lit(3.0))
    assert lit(spark, numbers.norm(a)) == 5.0
    assert lit(spark, numbers.cosine_similarity(a, b)) == pytest.approx(0.96)
    assert lit(spark, numbers.has_dimension(a, 2))
    assert lit(spark, numbers.percent(F.lit(0.456789))) == 45.68


def test_masks(spark):
    assert lit(spark, masks.card_number(F.lit("NA"))) == "NA"
    assert lit(spark, masks.card_number(F.lit("4111111111111234"))) == "X" * 12 + "1234"
    assert lit(spark, masks.card_number_for(F.lit("4111111111111234"), F.lit(False))) == "XXXX-XXXX-XXXX-1234"
    assert lit(spark, masks.email(F.lit("a.b@mail.example"))) == "XXXXX@mail.example"
    assert lit(spark, masks.last_four(F.lit("CUST_30697"))) == "XXXXX0697"
    masks.register_card_mask(spark)
    assert spark.sql("SELECT mask_card_number('4111111111111234') AS v").first().v == "X" * 12 + "1234"


def test_store_keys_of_any_length(spark):
    cases = {"Store 48": "STORE_048", "0000": "STORE_000", "007": "STORE_007", "1234": "STORE_1234", "none": "none", None: None}
    cases |= {"9" * 19: "STORE_" + "9" * 19, "0" * 5 + "1" * 40: "STORE_" + "1" * 40}
    df = spark.createDataFrame([(k,) for k in cases], "raw string")
    assert {r.raw: r.key for r in df.select("raw", text.store_key(F.col("raw")).alias("key")).collect()} == cases
