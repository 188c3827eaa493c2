import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aislewise.operators import contracts as C
from aislewise.operators import governance as G
from aislewise.operators import quality as Q
from aislewise.plans import guards


def results(df):
    return {r.rule_id: (r.value, r.ok) for r in df.collect()}


def test_rules_values_and_failures(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", -1.0), (None, None), ("b", 2.0)], "k string, v double")
    rules = [
        Q.holds("present", "completeness", F.col("k").isNotNull(), 0.75),
        Q.holds("positive", "validity", F.col("v") >= 0),
        Q.counted("many", "timeliness", F.col("v") > 0, 2),
        Q.Rule("uniq", "uniqueness", unique=("k",)),
        Q.Rule("nothing", "validity", F.max(F.lit(None).cast("double")), "<="),
    ]
    got = results(Q.evaluate(df, "t", rules))
    assert got == {
        "present": (0.75, True), "positive": (0.5, False), "many": (2.0, True), "uniq": (pytest.approx(2 / 3), False),
        "nothing": (None, False),
    }
    empty = results(Q.evaluate(df.limit(0), "t", rules[:2]))
    assert empty == {"present": (None, False), "positive": (None, False)}


@pytest.mark.parametrize("op, ok", [(">=", True), ("<=", True), ("==", True), (">", False), ("<", False)])
def test_operators(spark, op, ok):
    rule = Q.Rule("r", "d", F.count(F.lit(1)), op, 3.0)
    assert Q.evaluate(spark.range(3), "t", [rule]).first().ok is ok


def test_reference_ratio_and_count_equality(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "u string")
    b = spark.createDataFrame([("x",), ("x",), ("z",)], "uri string")
    assert Q.referenced_ratio(a, "u", b, "uri").first().value == 0.5
    assert Q.same_count(a, b).first().value == 0
    assert Q.same_count(b, b).first().value == 1


def test_warranty_contract(spark):
    df = spark.createDataFrame(
        [("p1", "n", 1.0, 12, "x" * 800), ("p2", "", 0.0, None, "short")],
        "product_id string, product_name string, retail_price_usd double, warranty_duration_months long, extracted_full_content string",
    )
    got = results(Q.evaluate(df, "w", C.warranty_rules()))
    assert got["product_id_unique"] == (1.0, True)
    assert all(got[r] == (0.5, False) for r in got if r not in ("product_id_unique", "product_id_not_null"))


def test_gold_scan_uses_exact_decimals(spark):
    df = spark.createDataFrame([("t", "0.30", "0.10", "0.10", "0.30", 1, 2)], "transaction_id string, subtotal_amount string, discount string, tax_amount string, total string, item_count long, total_quantity long")
    money = [F.col(c).cast("decimal(38,9)").alias(c) for c in ("subtotal_amount", "discount", "tax_amount", "total")]
    df = df.select("transaction_id", *money, "item_count", "total_quantity")
    assert all(ok for _, ok in results(Q.evaluate(df, "g", C.gold_scan_rules())).values())


def test_schema_diff(spark):
    live = T.StructType.fromDDL("a int, b array<struct<x: string, z: int>>, d string")
    want = T.StructType.fromDDL("a bigint, b array<struct<x: string, y: int>>, c date")
    got = {r.path: r.issue for r in Q.schema_diff(spark, want, live).collect()}
    assert got == {"a": "TYPE", "b": "OK", "b.x": "OK", "b.y": "MISSING", "b.z": "EXTRA", "c": "MISSING", "d": "EXTRA"}


def test_contract_schemas_parse():
    sizes = {n: len(G.field_rows(C.schema(n))) for n in C.SCHEMAS}
    assert sizes["pos_transactions_gold"] == 31 and sizes["historical_transactional_data"] == 41
    assert sizes["gold_inventory_reconciliation_ledger"] == 12 and sizes["pos_anomaly_alerts"] == 9


def test_linkage_and_summary(spark):
    rules = spark.createDataFrame(
        [("c", "r1", "validity", "eval-fixture"), ("c", "r2", "validity", "eval-fixture"), ("c", "r3", "validity", "not-enforced")],
        "contract string, rule_id string, dimension string, enforced_by string",
    )
    asserted = spark.createDataFrame(
        [("c", "r1", "timeliness"), ("c", "r9", "validity"), ("c", "r3", "validity"), ("c", "r3", "validity")],
        "contract string, rule_id string, dimension string",
    )
    got = {(r.rule_id, r.issue) for r in Q.linkage(rules, asserted).collect()}
    assert got == {
        ("r2", "RULE_WITHOUT_ASSERTION"), ("r9", "ASSERTION_WITHOUT_RULE"), ("r3", "REPEATED_ASSERTION"), ("r1", "DIMENSION_DIFFERS"),
    }
    res = spark.createDataFrame([("a", True), ("a", False), ("b", True)], "contract string, ok boolean")
    assert {r.contract: r.all_ok for r in Q.summary(res).collect()} == {"a": False, "b": True}


KV = "row_key string, risk_score double, cashier_1h_txn_count long, cashier_1h_manual_override_count long, cashier_1h_promo_rate double, audit_status string, last_event_ts timestamp"


def test_kv_checks(spark):
    def key(prefix, second):
        return f"{prefix}#{2**63 - 1 - second * 10**6:019d}", dt.datetime.fromtimestamp(second, dt.timezone.utc)

    (a, at), (b, bt), (c, ct) = key("STORE_001#CASH_1", 1_000), key("STORE_001#CASH_1", 900), key("STORE_1#CASH_1", 800)
    good = [(a, 0.5, 3, 1, 0.2, "clear", at), (b, 0.1, 3, 3, 1.0, "review", bt)]
    got = results(Q.kv_checks(spark.createDataFrame(good, KV), "STORE_001#CASH_1#"))
    assert len(got) == 9 and all(ok for _, ok in got.values())
    bad = [(c, 1.5, None, 4, 1.2, "odd", ct), ("STORE_001#CASH_1#99", None, 1, 4, 0.0, None, bt), good[0]]
    got = results(Q.kv_checks(spark.createDataFrame(bad, KV), "STORE_001#CASH_1#"))
    assert {k for k, (_, ok) in got.items() if ok} == {"row_key_prefix_exists", "counters_non_negative"}
    assert got["core_qualifiers_present"][0] == 3.0
    none = results(Q.kv_checks(spark.createDataFrame([], KV), "STORE_001#CASH_1#"))
    assert not any(ok for _, ok in none.values())


def test_newest_first(spark):
    """Plain, unreversed times of equal width do not pass: each suffix is compared with its own row's time."""
    rows = [(f"S#C#{2**63 - 1 - s * 10**6}", s) for s in (5, 6)] + [(f"S#D#{10**18 + s * 10**6}", s) for s in (5, 6)]
    rows += [(f"S#E#{2**63 - 1 - 7 * 10**6}", 7), (f"S#E#{2**63 - 1 - 9 * 10**6}", 8), ("S#F#1", None)]
    at = lambda s: s and dt.datetime.fromtimestamp(s, dt.timezone.utc)
    df = spark.createDataFrame([(k, at(s)) for k, s in rows], "row_key string, last_event_ts timestamp")
    want = {"S#C": True, "S#D": False, "S#E": False, "S#F": False}
    assert {r.prefix: r.newest_first for r in Q.newest_first(df).collect()} == want


def test_profiles(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, "b"), (3, "b")], "n int, s string")
    got = {r.column_name: r.asDict() for r in Q.profile(df).collect()}
    assert got["n"] == {"column_name": "n", "n_rows": 4, "n_nulls": 1, "null_ratio": 0.25, "n_distinct": 2, "top_count": 2, "min_number": 1.0, "max_number": 3.0}
    assert (got["s"]["n_distinct"], got["s"]["min_number"]) == (2, None)
    quick = {r.column_name: r for r in Q.quick_profile(df, ["n", "s"]).collect()}
    assert quick["n"].quantiles == [1.0, 1.0, 3.0] and quick["s"].quantiles is None
    assert Q.profile(df, ["n"], sample=1.0).count() == 1


def test_export(spark, tmp_path):
    df = Q.evaluate(spark.range(2), "t", [Q.holds("r", "d", F.col("id") >= 0)])
    for day in ("2026-01-01", "2026-01-02"):
        Q.export_results(df, str(tmp_path / "dq"), day)
    assert spark.read.parquet(str(tmp_path / "dq")).count() == 2


# Governance.

POLICIES = {
    "customer_name": G.TagPolicy(frozenset({"lead"}), {"analyst": "SHA256"}),
    "customer_id": G.TagPolicy(frozenset({"lead"}), {"analyst": "LAST_FOUR"}),
    "financial_amount": G.TagPolicy(frozenset({"lead"}), {"analyst": "DEFAULT"}),
}


def sales(spark):
    df = spark.createDataFrame([("S1", "c_1234567", "Ann", 9.5), ("S2", "c_7654321", "Bob", 1.5)], "store string, cid string, name string, usd double")
    return G.tag_columns(df, {"cid": "customer_id", "name": "customer_name", "usd": "financial_amount"})


def test_personas(spark):
    import hashlib

    df = sales(spark)
    grants = [G.RowGrant(frozenset({"lead"}), F.lit(True)), G.RowGrant(frozenset({"analyst"}), F.col("usd") > 5)]
    assert G.secured_view(df, "lead", POLICIES, grants).count() == 2
    masked = G.secured_view(df, "analyst", POLICIES, grants).collect()
    assert [tuple(r) for r in masked] == [("S1", "XXXXX4567", hashlib.sha256(b"Ann").hexdigest(), 0.0)]
    with pytest.raises(PermissionError, match="cid, name, usd"):
        G.secured_view(df, "guest", POLICIES, grants)
    assert G.secured_view(df, "guest", POLICIES, grants, ["store"]).count() == 0


def test_masks_by_type(spark):
    df = spark.createDataFrame([(1, 2.5, "x@y", True, dt.date(2026, 1, 1))], "i int, d double, s string, b boolean, t date")
    for mask, want in [("DEFAULT", (0, 0.0, "", False, dt.date(1970, 1, 1))), ("ALWAYS_NULL", (None,) * 5)]:
        tagged = G.tag_columns(df, {c: "p" for c in df.columns})
        got = G.secured_view(tagged, "a", {"p": G.TagPolicy(masked={"a": mask})})
        assert tuple(got.first()) == want and [f.dataType for f in got.schema] == [f.dataType for f in df.schema]


def test_attribute_policy(spark):
    df = spark.createDataFrame([("S1",), ("S2",)], "store string")
    assert df.filter(G.own_store_or_global(F.col("store"), "S1", "STORE_MANAGER")).count() == 1
    assert df.filter(G.own_store_or_global(F.col("store"), "S9", "GLOBAL_AUDITOR")).count() == 2


def test_tag_audit_and_facts(spark):
    audit = G.tag_audit(spark, {"sales": sales(spark), "plain": spark.range(1)}).collect()
    assert [(r.table_name, r.column_name, r.tag_value) for r in audit] == [
        ("sales", "cid", "customer_id"), ("sales", "name", "customer_name"), ("sales", "usd", "financial_amount"),
    ]
    facts = G.dataset_facts({"sales": (sales(spark), "NATIVE", "ops"), "plain": (spark.range(3), "NATIVE", "ops")})
    assert [(r.table_name, r.row_count) for r in facts.filter("NOT contains_pii").collect()] == [("plain", 3)]


# Guards.


def test_partition_and_scan_guards(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).select(F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") % 3).cast("int")).alias("business_date"), "id").write.partitionBy("business_date").parquet(path)
    df = spark.read.parquet(path)
    with pytest.raises(guards.PartitionFilterError):
        guards.require_partition_filter(df.groupBy("id").count(), "business_date")
    with pytest.raises(guards.PartitionFilterError):
        guards.require_partition_filter(df.filter("business_date IS NOT NULL"), "business_date")
    one_day = df.filter("business_date = DATE '2026-01-02'")
    assert guards.require_partition_filter(one_day, "business_date").count() == 33
    assert guards.require_partition_filter(df, "business_date", exempt=[path]) is df
    df.write.mode("overwrite").partitionBy("business_date").saveAsTable("dated_t")
    whole = spark.table("dated_t")
    assert guards.scan_bytes(whole) > guards.scan_bytes(whole.filter("business_date = DATE '2026-01-02'")) > 0
    guards.require_scan_within(df)
    with pytest.raises(guards.ScanLimitError):
        guards.require_scan_within(df, 10)
    other = df.filter("id = 5").withColumnRenamed("business_date", "my_business_date")
    with pytest.raises(guards.PartitionFilterError):
        guards.require_partition_filter(other.filter("my_business_date > DATE '2026-01-01'"), "date")


def test_guards_refuse_scans_they_do_not_understand(spark, tmp_path):
    """The second reader of files shows as a batch scan, an RDD as an existing one: neither lists partition filters."""
    path = str(tmp_path / "v2")
    spark.range(10).write.parquet(path)
    old = spark.conf.get("spark.sql.sources.useV1SourceList")
    spark.conf.set("spark.sql.sources.useV1SourceList", "")
    try:
        with pytest.raises(guards.PartitionFilterError):
            guards.require_partition_filter(spark.read.parquet(path).filter("id = 1"), "business_date")
    finally:
        spark.conf.set("spark.sql.sources.useV1SourceList", old)
    with pytest.raises(guards.PartitionFilterError):
        guards.require_partition_filter(spark.createDataFrame(spark.sparkContext.parallelize([(1,)]), "id int"), "id")
    assert guards.require_partition_filter(spark.range(5), "id").count() == 5


def test_repeated_records_differ_from_plain_ones(spark):
    plain = T.StructType.fromDDL("a struct<x:int>, b array<struct<x:int>>, c string")
    live = T.StructType.fromDDL("a array<struct<x:int>>, b array<struct<x:int>>, c string")
    issues = {r.path: r.issue for r in Q.schema_diff(spark, plain, live).collect()}
    assert issues["a"] == "TYPE" and issues["b"] == issues["c"] == "OK"


def test_contracts_over_one_table_share_one_pass(spark, tmp_path):
    data = [(1, 5), (1, -2), (2, None), (None, 3), (None, 4), (3, 0)]
    spark.createDataFrame(data, "k int, v int").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    rules = [
        Q.holds("positive", "validity", F.col("v") >= 0, 0.5), Q.counted("large", "validity", F.col("v") > 3),
        Q.Rule("unique", "uniqueness", unique=("k",)),
    ]
    other = [Q.holds("known", "completeness", F.col("k").isNotNull())]
    both = Q.evaluate_all([("a", df, rules), ("b", df, other)])
    got = {(r.contract, r.rule_id): (round(r.value, 6), r.ok) for r in both.collect()}
    assert got == {
        ("a", "positive"): (round(4 / 6, 6), True), ("a", "large"): (2.0, True), ("a", "unique"): (0.75, False), ("b", "known"): (round(4 / 6, 6), False),
    }
    assert both._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 1
    none = {r.rule_id: (r.value, r.ok) for r in Q.evaluate(df.limit(0), "a", rules).collect()}
    assert none == {"positive": (None, False), "large": (0.0, False), "unique": (None, False)}
    separate = {r.rule_id: r.value for r in Q.evaluate(df, "a", [*rules, Q.Rule("pair", "uniqueness", unique=("k", "v"))]).collect()}
    assert separate["unique"] == 0.75 and separate["positive"] == 4 / 6 and separate["pair"] == 1.0
