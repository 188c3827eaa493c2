import datetime as dt

import pytest
from pyspark.sql import functions as F

from aislewise.operators import graph as G

T = dt.datetime(2026, 1, 1)


@pytest.fixture(scope="module")
def g(spark):
    sup = spark.createDataFrame(
        [("s1", "F1", "DE", 0.9, False), ("s2", "F2", "FR", 0.3, True), ("s3", "F3", "IT", 0.1, True)],
        "supplier_id string, facility_name string, country string, risk_score double, certified boolean",
    )
    lot = spark.createDataFrame(
        [
            ("b1", "i1", "One", G.FLAGGED, "x", "NONE"),
            ("b2", "i2", "Two", G.PASSED, None, "FULL_RECALL"),
            ("b3", "i3", "Three", G.PASSED, None, None),
            ("b4", "i4", "Four", G.PASSED, None, "NONE"),
        ],
        "batch_id string, item_id string, item_name string, qa_inspection_status string, harmful_material_defect string, "
        "recall_status string",
    ).withColumn("manufacturing_date", F.lit("2026-01-01").cast("date"))
    cust = spark.createDataFrame(
        [("c1", "Ann", "GOLD"), ("c2", "Bob", "PLATINUM"), ("c3", "Cy", "SILVER")],
        "customer_id string, name string, loyalty_tier string",
    ).select("*", F.lit("e").alias("email"), F.lit("p").alias("phone_number"), F.lit("EU").alias("global_region"))
    store = spark.createDataFrame([("t1",), ("t2",), ("t3",)], "store_id string").select(
        "store_id", *[F.lit(x).alias(x) for x in ("store_name", "city", "country", "region")]
    )
    made = spark.createDataFrame(
        [("e1", "s1", "b1"), ("e2", "s1", "b2"), ("e3", "s2", "b3"), ("e4", "s3", "b4")],
        "edge_id string, source_supplier_id string, target_batch_id string",
    )
    sale = spark.createDataFrame(
        [
            ("x1", "b1", "c1", "t1", "tx1", T, "n1", None),
            ("x2", "b2", "c2", "t9", "tx2", T + dt.timedelta(1), "n2", "FALSE"),
            ("x3", "b3", "c3", "t2", "tx3", T, "n3", None),
            ("x4", "b1", "c3", "t2", "tx4", T + dt.timedelta(2), "n4", "CONTAMINATED_HARMFUL"),
            ("x5", "b4", "c2", "t2", "tx5", T, "n5", "TRUE"),
        ],
        "edge_id string, batch_id string, target_customer_id string, store_id string, transaction_id string, "
        "purchase_timestamp timestamp, serial_number string, exposure_flag string",
    ).select("*", F.lit(1.0).alias("unit_price_usd"), F.lit("USD").alias("currency"))
    shipped = spark.createDataFrame([("h1", "b1", "t1"), ("h2", "b9", "t1")], "edge_id string, src string, dst string")
    return G.PropertyGraph(
        {
            "Supplier": G.Nodes(sup, "supplier_id"),
            "BatchLot": G.Nodes(lot, "batch_id"),
            "Customer": G.Nodes(cust, "customer_id"),
            "Store": G.Nodes(store, "store_id"),
        },
        {
            "PRODUCED_BATCH": G.Edges(made, "edge_id", ("source_supplier_id", "Supplier"), ("target_batch_id", "BatchLot")),
            "PURCHASED_LOT_BY_CUSTOMER": G.Edges(sale, "edge_id", ("batch_id", "BatchLot"), ("target_customer_id", "Customer")),
            "SHIPPED_TO": G.Edges(shipped, "edge_id", ("src", "BatchLot"), ("dst", "Store")),
        },
    )


def test_counts_and_violations(g):
    assert {r.table_name: r.row_count for r in g.row_counts().collect()}["Customer"] == 3
    bad = {(r.table_name, r.rule): r.violations for r in g.violations().collect() if r.violations}
    assert bad == {("SHIPPED_TO", "source_not_found"): 1}


def test_walks(spark):
    edges = spark.createDataFrame(
        [("e1", "L", "A"), ("e2", "A", "B"), ("e3", "B", "C"), ("e4", "C", "A"), ("e5", "A", "X")],
        "edge_id string, src string, dst string",
    )
    lots = spark.createDataFrame([("L",)], "id string")
    ends = spark.createDataFrame([("A",), ("B",), ("C",)], "id string")
    got = {(r.end_id, r.hops): r.path_json for r in G.walks(lots, edges, ends, 1, 3).collect()}
    assert set(got) == {("A", 1), ("B", 2), ("C", 3)}
    assert got[("A", 1)] == '[{"src":"L","edge_id":"e1","dst":"A"}]'
    looped = G.walks(lots, edges, ends, 1, 4, checkpoint=True).collect()
    assert ("A", 4) in {(r.end_id, r.hops) for r in looped}
    assert {r.hops for r in G.walks(lots, edges, ends, 2, 3).collect()} == {2, 3}


def test_vip_recall(g):
    got = G.vip_order(G.vip_recall(g)).collect()
    assert [(r.customer_id, r.batch_id) for r in got] == [("c2", "b2"), ("c1", "b1")]


def test_co_exposure_allows_the_same_lot(g):
    got = G.co_exposure(g, F.lit("c1")).collect()
    assert {(r.secondary_customer_id, r.secondary_batch_id) for r in got} == {("c2", "b2"), ("c3", "b1")}


def test_contacts_newest_first(g):
    assert [r.customer_id for r in G.recall_contacts(g, F.lit("b1")).collect()] == ["c3", "c1"]
    assert G.recall_contacts(g, F.lit("b2")).count() == 0


def test_scorecard(g):
    top = G.supplier_scorecard(g).first()
    assert (top.supplier_id, top.total_lots_produced, top.passed_clean_lots, top.flagged_harmful_lots, top.defect_rate_pct) == (
        "s1", 2, 1, 1, 50.0,
    )


def test_recall_flag_is_three_valued(g):
    view = {r.transaction_id: r for r in G.recall_360(g, g.nodes["Store"].table).collect()}
    assert len(view) == 5
    assert view["tx1"].is_active_recall is True and view["tx5"].is_active_recall is True
    assert view["tx3"].is_active_recall is None
    assert view["tx2"].store_name is None and view["tx1"].store_name == "store_name"
    assert view["tx3"].supplier_risk_category == "MODERATE_RISK"
    ledger = G.dispatch(G.recall_360(g, g.nodes["Store"].table), F.lit("b1")).collect()
    assert [r.transaction_id for r in ledger] == ["tx4", "tx1"]


def test_right_ends_first(spark):
    """The same rows; the columns of the wide left side are not carried through the join with the right ends."""
    left = spark.createDataFrame([(1, "x"), (2, "y")], "k int, wide string")
    edge = spark.createDataFrame([(1, 1, 7), (2, 1, 8), (3, 2, 7), (4, None, 7), (5, 2, None)], "e int, src int, dst int")
    right = spark.createDataFrame([(7, "u"), (8, "v"), (9, "w")], "k int, name string")
    g = G.PropertyGraph({"L": G.Nodes(left, "k"), "R": G.Nodes(right, "k")}, {"E": G.Edges(edge, "e", ("src", "L"), ("dst", "R"))})
    step = lambda first: g.step(g.node("L", "l"), "l", "E", "e", g.node("R", "r"), "r", right_first=first)
    assert step(True).columns == step(False).columns
    assert sorted(step(True).collect()) == sorted(step(False).collect()) and step(True).count() == 3
    top = lambda df: df._jdf.queryExecution().analyzed().children().apply(0).nodeName()
    assert (top(step(False)), top(step(True))) == ("Join", "Project")


def test_lots_are_told_apart_by_their_numbers(spark):
    """The text of a lot's id is made after its rows are brought together, so it is not shuffled for that."""
    from workload.graph_queries import recall_graph

    lots = recall_graph(spark, "/root/testdata/sf0.001").nodes["BatchLot"].table
    line = next(x for x in lots._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Aggregate [" in x)
    assert "l_partkey" in line and "l_suppkey" in line and "batch_id" not in line


def write_tables(spark, path) -> str:
    """Few rows of the tables the recall graph is made of: parts, suppliers and orders that come twice, and keys that are NULL."""
    day = dt.datetime(2026, 1, 2)
    tables = {
        "nation": ([(0, "N0", 0), (1, "N1", 1)], "n_nationkey int, n_name string, n_regionkey int"),
        "supplier": ([(3, "S3", 0), (4, "S4", 1), (4, "S4b", 1), (5, "S5", None), (None, "S", 0)], "s_suppkey long, s_name string, s_nationkey int"),
        "part": (
            [(1, "p1", "B1", "PROMO", 3), (1, "p1b", "B2", "STANDARD", 20), (2, "p2", "B3", None, 50), (None, "p", "B4", "LARGE", 1), (-2, "p3", None, "PROMO", None)],
            "p_partkey long, p_name string, p_brand string, p_type string, p_size int",
        ),
        "customer": (
            [(7, "C7", 0, "MACHINERY"), (8, "C8", 1, None), (8, "C8b", 1, "HOUSEHOLD"), (9, "C9", None, "X"), (None, "C", 0, "X")],
            "c_custkey long, c_name string, c_nationkey int, c_mktsegment string",
        ),
        "orders": ([(10, 7, day), (11, 8, None), (11, 8, day), (12, 9, day), (13, None, day), (None, 7, day)], "o_orderkey long, o_custkey long, o_orderdate timestamp"),
        "lineitem": (
            [(10, 1, 3, 1, 1.5, "R"), (10, 1, 3, 1, 1.5, "R"), (10, 2, 4, 2, None, "A"), (11, 1, 4, 1, 2.5, "N"), (11, -2, 3, 2, 2.5, None),
             (12, 1, 3, 1, 3.5, "R"), (13, 1, 3, 1, 3.5, "R"), (None, 1, 3, 1, 3.5, "R"), (10, None, 3, 3, 4.5, "R"), (10, 1, None, 4, 4.5, "R"),
             (10, 1, 5, 5, 5.5, "R"), (10, 6, 3, 6, 5.5, "R")],
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, l_returnflag string",
        ),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")
    return str(path)


def sorted_rows(df) -> list[str]:
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("small_bytes", [0, 1 << 20])
def test_all_lots_have_the_sales_that_lots_have(spark, g, tmp_path, small_bytes):
    """Slim joins give the same rows and columns, where rows come twice and keys are NULL too, and for tables without slim forms."""
    from workload.graph_queries import recall_graph

    odd = recall_graph(spark, write_tables(spark, tmp_path))
    for graph in (odd, g):
        want, got = G.sales_of_lots(graph), G.sales_of_all_lots(graph, small_bytes)
        assert (got.columns, [t for _, t in got.dtypes]) == (want.columns, [t for _, t in want.dtypes])
        assert sorted_rows(got) == sorted_rows(want)
    assert G.sales_of_lots(odd).count() > 10
    stores = odd.nodes["Store"].table
    assert sorted_rows(G.recall_360(odd, stores, whole=True)) == sorted_rows(G.recall_360(odd, stores))


def test_the_whole_view_computes_columns_after_its_joins(spark, tmp_path):
    from workload.graph_queries import recall_360

    plan = recall_360(spark, write_tables(spark, tmp_path))._jdf.queryExecution().optimizedPlan().toString().splitlines()
    first = next(k for k, x in enumerate(plan) if "Join Inner" in x)
    below = "\n".join(plan[first:])
    assert "CONTAMINATED_HARMFUL" in "\n".join(plan[:first])
    assert not any(x in below for x in ("@mail.example", "CONTAMINATED_HARMFUL", "LOT-", "FULL_RECALL"))
