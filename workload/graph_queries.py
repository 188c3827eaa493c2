"""The supply graph: suppliers, lots (part and supplier), customers, and nations as stores."""

from pyspark.sql import functions as F

from aislewise.operators import graph as G
from aislewise.operators.places import places
from aislewise.operators.sql_functions import publish_graph, publish_text_functions
from workload import views as V
from workload.document_queries import CHUNKS_SQL
from workload.registry import query


def lot_id(c):
    return F.concat(F.lit("LOT-"), c("l_partkey").cast("string"), F.lit("-"), c("l_suppkey").cast("string"))


def recall_graph(spark, sf_dir) -> G.PropertyGraph:
    line, order = V.table(spark, sf_dir, "lineitem"), V.table(spark, sf_dir, "orders")
    part, sup = V.table(spark, sf_dir, "part"), V.table(spark, sf_dir, "supplier")
    nation, cust = V.table(spark, sf_dir, "nation"), V.table(spark, sf_dir, "customer")
    lot_parts = ("l_partkey", "l_suppkey")

    suppliers = G.Slim(
        sup.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "s_name", "n_name"),
        lambda c: {
            "supplier_id": c("s_suppkey"),
            "facility_name": c("s_name"),
            "country": c("n_name"),
            "risk_score": F.pmod(c("s_suppkey") * 37, F.lit(100)) / 100.0,
            "certified": F.pmod(c("s_suppkey"), F.lit(3)) == 0,
        },
        {"supplier_id": ("s_suppkey",)},
    )
    # Three-valued: neither is told by NULL.
    flagged = F.when(F.col("p_type") == "PROMO", True).when(F.col("p_type") == "STANDARD", False)
    returned = F.when(F.col("l_returnflag") == "R", True).when(F.col("l_returnflag") == "A", False)
    lots = G.Slim(
        line.select(*lot_parts)
        .distinct()
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select(*lot_parts, "p_name", flagged.alias("flagged"), F.when(flagged, F.col("p_brand")).alias("defect"), "p_size"),
        lambda c: {
            "batch_id": lot_id(c),
            "item_id": c("l_partkey"),
            "item_name": c("p_name"),
            "supplier_id": c("l_suppkey"),
            "qa_inspection_status": F.when(c("flagged"), G.FLAGGED).when(~c("flagged"), G.PASSED).otherwise("PENDING"),
            "harmful_material_defect": c("defect"),
            "recall_status": F.when(c("p_size") <= 5, "FULL_RECALL").when(c("p_size") <= 40, "NONE"),
            "manufacturing_date": F.lit("1995-01-01").cast("date"),
        },
        {"batch_id": lot_parts},
    )
    tier = F.when(F.col("c_mktsegment") == "MACHINERY", "PLATINUM").when(F.col("c_mktsegment") == "HOUSEHOLD", "GOLD")
    customers = G.Slim(
        cust.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
            "c_custkey", "c_name", tier.otherwise("SILVER").alias("tier"), "n_name"
        ),
        lambda c: {
            "customer_id": c("c_custkey"),
            "name": c("c_name"),
            "loyalty_tier": c("tier"),
            "email": F.concat(c("c_custkey").cast("string"), F.lit("@mail.example")),
            "phone_number": F.concat(F.lit("555-"), c("c_custkey").cast("string")),
            "global_region": c("n_name"),
        },
        {"customer_id": ("c_custkey",)},
    )
    produced = G.Slim(
        lots.table.select(*lot_parts),
        lambda c: {
            "edge_id": F.concat(F.lit("P-"), lot_id(c)),
            "source_supplier_id": c("l_suppkey"),
            "target_batch_id": lot_id(c),
        },
        {"source_supplier_id": ("l_suppkey",), "target_batch_id": lot_parts},
    )
    sales = G.Slim(
        line.select("l_orderkey", *lot_parts, "l_linenumber", "l_extendedprice", returned.alias("returned")),
        lambda c: {
            "edge_id": F.concat_ws("-", c("l_orderkey").cast("string"), c("l_linenumber").cast("string")),
            "batch_id": lot_id(c),
            "target_customer_id": c("o_custkey"),
            "store_id": F.pmod(c("l_orderkey"), F.lit(30)),
            "transaction_id": c("l_orderkey"),
            "purchase_timestamp": c("o_orderdate"),
            "serial_number": c("l_linenumber"),
            "unit_price_usd": c("l_extendedprice"),
            "currency": F.lit("USD"),
            "exposure_flag": F.when(c("returned"), "CONTAMINATED_HARMFUL").when(~c("returned"), "FALSE"),
        },
        {"batch_id": lot_parts, "target_customer_id": ("o_custkey",)},
        head=(order.select("o_orderkey", "o_custkey", "o_orderdate"), "l_orderkey", "o_orderkey"),
    )
    stores = nation.select(
        F.col("n_nationkey").alias("store_id"),
        F.col("n_name").alias("store_name"),
        F.upper("n_name").alias("city"),
        F.col("n_name").alias("country"),
        F.col("n_regionkey").cast("string").alias("region"),
    )
    sold = line.join(order, F.col("l_orderkey") == F.col("o_orderkey"))
    shipped = (
        sold.join(cust.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .select(lot_id(F.col).alias("src"), F.col("c_nationkey").alias("dst"))
        .distinct()
        .select(F.concat_ws(">", "src", "dst").alias("edge_id"), "src", "dst")
    )
    return G.PropertyGraph(
        {
            "Supplier": G.Nodes(suppliers.full(), "supplier_id", suppliers),
            "BatchLot": G.Nodes(lots.full(), "batch_id", lots),
            "Customer": G.Nodes(customers.full(), "customer_id", customers),
            "Store": G.Nodes(stores, "store_id"),
        },
        {
            "PRODUCED_BATCH": G.Edges(
                produced.full(), "edge_id", ("source_supplier_id", "Supplier"), ("target_batch_id", "BatchLot"), produced
            ),
            "PURCHASED_LOT_BY_CUSTOMER": G.Edges(
                sales.full(), "edge_id", ("batch_id", "BatchLot"), ("target_customer_id", "Customer"), sales
            ),
            "SHIPPED_TO": G.Edges(shipped, "edge_id", ("src", "BatchLot"), ("dst", "Store")),
        },
    )


GRAPH_SQL = """
sup AS (
  SELECT s_suppkey AS supplier_id, s_name AS facility_name, n_name AS country,
         (s_suppkey * 37 % 100) / 100e0 AS risk_score, s_suppkey % 3 = 0 AS certified
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
),
lot AS (
  SELECT DISTINCT 'LOT-' || l_partkey || '-' || l_suppkey AS batch_id, l_partkey AS item_id, p_name AS item_name,
         l_suppkey AS supplier_id,
         CASE p_type WHEN 'PROMO' THEN 'FLAGGED_HARMFUL_MATERIAL' WHEN 'STANDARD' THEN 'PASSED_CLEAN' ELSE 'PENDING' END
           AS qa_inspection_status,
         CASE WHEN p_type = 'PROMO' THEN p_brand END AS harmful_material_defect,
         CASE WHEN p_size <= 5 THEN 'FULL_RECALL' WHEN p_size <= 40 THEN 'NONE' END AS recall_status,
         DATE '1995-01-01' AS manufacturing_date
  FROM lineitem JOIN part ON l_partkey = p_partkey
),
cust AS (
  SELECT c_custkey AS customer_id, c_name AS name,
         CASE c_mktsegment WHEN 'MACHINERY' THEN 'PLATINUM' WHEN 'HOUSEHOLD' THEN 'GOLD' ELSE 'SILVER' END AS loyalty_tier,
         c_custkey || '@mail.example' AS email, '555-' || c_custkey AS phone_number, n_name AS global_region,
         c_nationkey
  FROM customer JOIN nation ON c_nationkey = n_nationkey
),
sale AS (
  SELECT 'LOT-' || l_partkey || '-' || l_suppkey AS batch_id, o_custkey AS customer_id, l_orderkey % 30 AS store_id,
         l_orderkey AS transaction_id, o_orderdate AS purchase_timestamp, l_linenumber AS serial_number,
         l_extendedprice AS unit_price_usd, 'USD' AS currency, l_orderkey || '-' || l_linenumber AS edge_id,
         CASE l_returnflag WHEN 'R' THEN 'CONTAMINATED_HARMFUL' WHEN 'A' THEN 'FALSE' END AS exposure_flag
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
pattern AS (
  SELECT sup.*, lot.* EXCLUDE (supplier_id), sale.* EXCLUDE (batch_id, customer_id), cust.*
  FROM sup JOIN lot USING (supplier_id) JOIN sale USING (batch_id) JOIN cust USING (customer_id)
)"""

FLAG_SQL = """(qa_inspection_status = 'FLAGGED_HARMFUL_MATERIAL' OR recall_status LIKE '%RECALL%'
  OR exposure_flag = 'TRUE' OR exposure_flag = 'CONTAMINATED_HARMFUL')"""
BAND_SQL = """CASE WHEN risk_score >= 0.75 THEN 'CRITICAL_HIGH_RISK' WHEN risk_score >= 0.30 THEN 'MODERATE_RISK'
  ELSE 'LOW_RISK' END"""


@query(
    "graph_row_counts",
    f"""WITH {GRAPH_SQL},
shipped AS (SELECT DISTINCT batch_id, c_nationkey FROM sale JOIN cust USING (customer_id))
SELECT 'Supplier' AS table_name, count(*) AS row_count FROM sup UNION ALL SELECT 'BatchLot', count(*) FROM lot
UNION ALL SELECT 'Customer', count(*) FROM cust UNION ALL SELECT 'Store', count(*) FROM nation
UNION ALL SELECT 'PRODUCED_BATCH', count(*) FROM lot UNION ALL SELECT 'PURCHASED_LOT_BY_CUSTOMER', count(*) FROM sale
UNION ALL SELECT 'SHIPPED_TO', count(*) FROM shipped""",
)
def graph_row_counts(spark, sf_dir):
    return recall_graph(spark, sf_dir).row_counts()


@query(
    "graph_violations",
    f"""WITH {GRAPH_SQL},
shipped AS (SELECT DISTINCT batch_id AS src, c_nationkey AS dst FROM sale JOIN cust USING (customer_id)),
keyed AS (
  SELECT 'Supplier' AS table_name, CAST(supplier_id AS VARCHAR) AS k FROM sup
  UNION ALL SELECT 'BatchLot', batch_id FROM lot UNION ALL SELECT 'Customer', CAST(customer_id AS VARCHAR) FROM cust
  UNION ALL SELECT 'Store', CAST(n_nationkey AS VARCHAR) FROM nation UNION ALL SELECT 'PRODUCED_BATCH', 'P-' || batch_id FROM lot
  UNION ALL SELECT 'PURCHASED_LOT_BY_CUSTOMER', edge_id FROM sale UNION ALL SELECT 'SOLD_AT', edge_id FROM sale
  UNION ALL SELECT 'SHIPPED_TO', src || '>' || dst FROM shipped
),
ends AS (
  SELECT 'PRODUCED_BATCH' AS table_name, 'source_not_found' AS rule, supplier_id IN (SELECT supplier_id FROM sup) AS known FROM lot
  UNION ALL SELECT 'PRODUCED_BATCH', 'target_not_found', batch_id IN (SELECT batch_id FROM lot) FROM lot
  UNION ALL SELECT 'PURCHASED_LOT_BY_CUSTOMER', 'source_not_found', batch_id IN (SELECT batch_id FROM lot) FROM sale
  UNION ALL SELECT 'PURCHASED_LOT_BY_CUSTOMER', 'target_not_found', customer_id IN (SELECT customer_id FROM cust) FROM sale
  UNION ALL SELECT 'SOLD_AT', 'source_not_found', batch_id IN (SELECT batch_id FROM lot) FROM sale
  UNION ALL SELECT 'SOLD_AT', 'target_not_found', store_id IN (SELECT n_nationkey FROM nation) FROM sale
  UNION ALL SELECT 'SHIPPED_TO', 'source_not_found', src IN (SELECT batch_id FROM lot) FROM shipped
  UNION ALL SELECT 'SHIPPED_TO', 'target_not_found', dst IN (SELECT n_nationkey FROM nation) FROM shipped
)
SELECT table_name, 'key_not_unique' AS rule, count(*) FILTER (k IS NOT NULL AND n > 1) AS violations
FROM (SELECT table_name, k, count(*) AS n FROM keyed GROUP BY ALL) GROUP BY 1
UNION ALL SELECT table_name, 'key_missing', count(*) FILTER (k IS NULL) FROM keyed GROUP BY 1
UNION ALL SELECT table_name, rule, count(*) FILTER (NOT known) FROM ends GROUP BY ALL""",
)
def graph_violations(spark, sf_dir):
    """Keys and ends of every table, and of sales by store, some of whose stores are not in the store table."""
    g = recall_graph(spark, sf_dir)
    sales = g.edges["PURCHASED_LOT_BY_CUSTOMER"].table
    sold_at = G.Edges(sales, "edge_id", ("batch_id", "BatchLot"), ("store_id", "Store"))
    return G.PropertyGraph(g.nodes, {**g.edges, "SOLD_AT": sold_at}).violations()


WALK_SQL = f"""{GRAPH_SQL},
shipped AS (SELECT DISTINCT batch_id AS src, c_nationkey AS dst FROM sale JOIN cust USING (customer_id)),
edges AS (
  SELECT src || '>' || dst AS edge_id, src, 'N' || dst AS dst FROM shipped
  UNION ALL SELECT 'N' || n_nationkey || '>N' || (n_nationkey * f + 1) % 25, 'N' || n_nationkey, 'N' || (n_nationkey * f + 1) % 25
  FROM nation, (SELECT unnest([3, 7]) AS f) WHERE f = 3 OR n_nationkey % 2 = 0
),
walk AS (
  SELECT batch_id AS start_id, dst AS end_id, 1 AS hops,
         '{{"src":"' || src || '","edge_id":"' || edge_id || '","dst":"' || dst || '"}}' AS steps
  FROM lot JOIN edges ON src = batch_id
  UNION ALL
  SELECT start_id, e.dst, hops + 1, steps || ',{{"src":"' || e.src || '","edge_id":"' || e.edge_id || '","dst":"' || e.dst || '"}}'
  FROM walk JOIN edges e ON e.src = end_id WHERE hops < 3
)"""


def shipments(spark, sf_dir):
    """Lots, their shipments to stores, the lanes between stores, and the stores; lanes give real multi-hop walks."""
    g = recall_graph(spark, sf_dir)
    n = F.col("n_nationkey")
    named = lambda number: F.concat(F.lit("N"), number.cast("string"))
    nation = V.table(spark, sf_dir, "nation")
    # One lane from every store, and a second one from half of them.
    lanes = nation.select("n_nationkey", F.explode(F.array(F.lit(3), F.lit(7))).alias("f")).where((F.col("f") == 3) | (n % 2 == 0))
    lanes = lanes.select(named(n).alias("src"), named((n * F.col("f") + 1) % 25).alias("dst"))
    lanes = lanes.select(F.concat_ws(">", "src", "dst").alias("edge_id"), "src", "dst")
    shipped = g.edges["SHIPPED_TO"].table.withColumn("dst", named(F.col("dst")))
    lots = g.nodes["BatchLot"].table.select(F.col("batch_id").alias("id"))
    return lots, shipped, lanes, nation.select(named(n).alias("id"), "n_nationkey")


@query("graph_paths_1_3", f"WITH RECURSIVE {WALK_SQL} SELECT start_id, end_id, hops, '[' || steps || ']' AS path_json FROM walk")
def graph_paths_1_3(spark, sf_dir):
    """Lots to stores over one to three shipments."""
    lots, shipped, lanes, stores = shipments(spark, sf_dir)
    return G.walks(lots, shipped, stores, 1, 3, onward=lanes).drop("path")


@query(
    "graph_walk_counts",
    f"""WITH RECURSIVE {WALK_SQL} SELECT start_id, end_id, hops, count(*) AS walks FROM walk
WHERE hops >= 2 AND end_id IN (SELECT 'N' || n_nationkey FROM nation WHERE n_nationkey % 5 = 1) GROUP BY ALL""",
)
def graph_walk_counts(spark, sf_dir):
    """How many walks of two or three shipments lead from each lot to each of some stores; none is written out."""
    lots, shipped, lanes, stores = shipments(spark, sf_dir)
    return G.walk_counts(lots, shipped, stores.where("n_nationkey % 5 = 1"), 2, 3, onward=lanes)


@query(
    "recall_vip",
    f"""WITH {GRAPH_SQL} SELECT customer_id, name AS customer_name, loyalty_tier, batch_id, item_id, item_name,
recall_status, serial_number, transaction_id, supplier_id, facility_name AS supplier_facility,
risk_score AS supplier_risk_score, email, phone_number, global_region AS customer_region,
harmful_material_defect AS defect_description, purchase_timestamp
FROM pattern WHERE risk_score >= 0.75 AND loyalty_tier IN ('PLATINUM', 'GOLD')
  AND (qa_inspection_status = 'FLAGGED_HARMFUL_MATERIAL' OR recall_status LIKE '%RECALL%'
       OR exposure_flag = 'CONTAMINATED_HARMFUL')""",
)
def recall_vip(spark, sf_dir):
    return G.vip_order(G.vip_recall(recall_graph(spark, sf_dir)))


INDEX_SQL = """
index_customer AS (
  SELECT customer_id AS c FROM pattern WHERE risk_score >= 0.75
  GROUP BY customer_id ORDER BY count(*) DESC, customer_id LIMIT 1
)"""


def index_customer(g):
    """The customer with the most purchases from high-risk suppliers: found once, so that it is a value to the pattern's scans."""
    hits = G.sales_of_lots(g, F.col("risk_score") >= G.HIGH_RISK).groupBy("cust_customer_id").count()
    found = hits.orderBy(F.desc("count"), "cust_customer_id").first()
    return F.lit(found.cust_customer_id if found else None)


@query(
    "co_exposure",
    f"""WITH {GRAPH_SQL}, {INDEX_SQL}
SELECT p.customer_id AS index_customer_id, p.name AS index_customer_name, p.batch_id AS index_batch_id, p.supplier_id,
       p.facility_name AS common_supplier_facility, p.risk_score AS supplier_risk_score,
       b2.batch_id AS secondary_batch_id, c2.customer_id AS secondary_customer_id, c2.name AS secondary_customer_name,
       c2.loyalty_tier AS secondary_loyalty_tier, p.item_name AS index_product_name,
       b2.item_name AS secondary_product_name, c2.email AS secondary_email, c2.phone_number AS secondary_phone_number
FROM pattern p JOIN lot b2 ON b2.supplier_id = p.supplier_id JOIN sale s2 ON s2.batch_id = b2.batch_id
JOIN cust c2 ON c2.customer_id = s2.customer_id
WHERE p.risk_score >= 0.75 AND p.customer_id = (SELECT c FROM index_customer) AND c2.customer_id <> p.customer_id""",
)
def co_exposure(spark, sf_dir):
    g = recall_graph(spark, sf_dir)
    return G.co_exposure(g, index_customer(g))


@query(
    "supplier_scorecard",
    f"""WITH {GRAPH_SQL} SELECT supplier_id, facility_name, country, risk_score, count(batch_id) AS total_lots_produced,
count(*) FILTER (qa_inspection_status = 'PASSED_CLEAN') AS passed_clean_lots,
count(*) FILTER (qa_inspection_status = 'FLAGGED_HARMFUL_MATERIAL') AS flagged_harmful_lots,
round(100e0 * count(*) FILTER (qa_inspection_status = 'FLAGGED_HARMFUL_MATERIAL') / count(batch_id), 2) AS defect_rate_pct
FROM sup JOIN lot USING (supplier_id) GROUP BY supplier_id, facility_name, country, risk_score""",
)
def supplier_scorecard(spark, sf_dir):
    return G.supplier_scorecard(recall_graph(spark, sf_dir))


VIEW_360_SQL = f"""
view_360 AS (
  SELECT transaction_id, serial_number AS hardware_serial_number, purchase_timestamp, item_id AS product_sku,
         item_name AS product_name, unit_price_usd, currency, {FLAG_SQL} AS is_active_recall, qa_inspection_status,
         harmful_material_defect AS defect_description, recall_status AS batch_recall_status,
         {BAND_SQL} AS supplier_risk_category, supplier_id, facility_name AS supplier_facility,
         p.country AS supplier_country, risk_score AS supplier_risk_score, certified AS is_supplier_certified,
         batch_id, manufacturing_date, store_id, n_name AS store_name, upper(n_name) AS store_city,
         n_name AS store_country, CAST(n_regionkey AS VARCHAR) AS store_region, customer_id, name AS customer_name,
         loyalty_tier AS customer_loyalty_tier, email AS customer_email, phone_number AS customer_phone,
         global_region AS customer_region
  FROM pattern p LEFT JOIN nation ON store_id = n_nationkey
)"""


def view_360(spark, sf_dir, whole=False):
    g = recall_graph(spark, sf_dir)
    return G.recall_360(g, g.nodes["Store"].table, whole)


@query("recall_360", f"WITH {GRAPH_SQL}, {VIEW_360_SQL} SELECT * FROM view_360")
def recall_360(spark, sf_dir):
    return view_360(spark, sf_dir, whole=True)


LOT_SQL = """
hot_lot AS (
  SELECT batch_id AS b FROM sale JOIN lot USING (batch_id) WHERE qa_inspection_status = 'FLAGGED_HARMFUL_MATERIAL'
  GROUP BY batch_id ORDER BY count(*) DESC, batch_id LIMIT 1
)"""


def hot_lot(g):
    """The flagged lot with the most sales."""
    lots = g.nodes["BatchLot"].table.filter(F.col("qa_inspection_status") == G.FLAGGED).select("batch_id")
    sales = g.edges["PURCHASED_LOT_BY_CUSTOMER"].table.select("batch_id")
    counts = sales.join(lots, "batch_id", "left_semi").groupBy("batch_id").count()
    return counts.orderBy(F.desc("count"), "batch_id").limit(1).select("batch_id").scalar()


@query(
    "recall_contacts",
    f"""WITH {GRAPH_SQL}, {LOT_SQL} SELECT batch_id, item_name, customer_id, name AS customer_name, loyalty_tier, store_id,
transaction_id, purchase_timestamp, serial_number, email, phone_number, global_region AS customer_region,
harmful_material_defect AS defect_description, unit_price_usd FROM lot JOIN sale USING (batch_id) JOIN cust USING (customer_id)
WHERE batch_id = (SELECT b FROM hot_lot) AND qa_inspection_status = 'FLAGGED_HARMFUL_MATERIAL'""",
)
def recall_contacts(spark, sf_dir):
    g = recall_graph(spark, sf_dir)
    return G.recall_contacts(g, hot_lot(g))


@query(
    "recall_dispatch",
    f"""WITH {GRAPH_SQL}, {VIEW_360_SQL}, {LOT_SQL} SELECT transaction_id, hardware_serial_number, product_name, batch_id,
customer_id, customer_name, customer_loyalty_tier, customer_email, customer_phone, store_id, store_name, store_city,
store_country, is_active_recall, supplier_risk_category, purchase_timestamp
FROM view_360 WHERE is_active_recall AND batch_id = (SELECT b FROM hot_lot)""",
)
def recall_dispatch(spark, sf_dir):
    g = recall_graph(spark, sf_dir)
    return G.dispatch(view_360(spark, sf_dir), hot_lot(g))


VIP_PLACES_SQL = f"""WITH {GRAPH_SQL} SELECT transaction_id, serial_number, row_number() OVER (ORDER BY loyalty_tier DESC,
risk_score DESC, name, transaction_id, serial_number) AS place
FROM pattern WHERE risk_score >= 0.75 AND loyalty_tier IN ('PLATINUM', 'GOLD')
  AND (qa_inspection_status = 'FLAGGED_HARMFUL_MATERIAL' OR recall_status LIKE '%RECALL%'
       OR exposure_flag = 'CONTAMINATED_HARMFUL')"""


@query("vip_places", VIP_PLACES_SQL)
def vip_places(spark, sf_dir):
    """Every row of the recall list, numbered as it stands in its order."""
    return places(G.vip_order(G.vip_recall(recall_graph(spark, sf_dir))), "transaction_id", "serial_number")


@query(
    "vip_order",
    f"""WITH {GRAPH_SQL} SELECT loyalty_tier, transaction_id, serial_number, row_number() OVER (PARTITION BY loyalty_tier
ORDER BY risk_score DESC, name, transaction_id, serial_number) AS place_in_tier
FROM pattern WHERE risk_score >= 0.75 AND loyalty_tier IN ('PLATINUM', 'GOLD')
  AND (qa_inspection_status = 'FLAGGED_HARMFUL_MATERIAL' OR recall_status LIKE '%RECALL%'
       OR exposure_flag = 'CONTAMINATED_HARMFUL')""",
)
def vip_order(spark, sf_dir):
    """Every row of the recall list, numbered inside its loyalty tier: its place in the list, less where the tier begins."""
    listed = G.vip_order(G.vip_recall(recall_graph(spark, sf_dir)))
    rows = places(listed, "loyalty_tier", "transaction_id", "serial_number")
    begins = rows.groupBy("loyalty_tier").agg((F.min("place") - 1).alias("before"))
    return rows.join(begins, "loyalty_tier").select(
        "loyalty_tier", "transaction_id", "serial_number", (F.col("place") - F.col("before")).alias("place_in_tier")
    )


MANUALS_SQL = """SELECT s.batch_id, c.chunk_index, count(*) AS sales, count(DISTINCT s.customer_id) AS customers,
  max(length(c.chunk_content)) AS chunk_chars
FROM {sales} s JOIN {chunks} c ON c.id = s.item_id GROUP BY s.batch_id, c.chunk_index"""


@query(
    "sql_lot_manuals",
    f"""WITH {GRAPH_SQL}, {CHUNKS_SQL}, risky AS (SELECT * FROM pattern WHERE risk_score >= 0.9),
numbered AS (SELECT doc_id AS id, chunk_index, chunk_content FROM chunks)
{MANUALS_SQL.format(sales="risky", chunks="numbered")}""",
)
def sql_lot_manuals(spark, sf_dir):
    """One SQL text that calls the recall pattern and the chunker, and joins lots to the chunks of their item's document."""
    publish_graph(spark, recall_graph(spark, sf_dir))
    publish_text_functions(spark)
    V.table(spark, sf_dir, "documents").createOrReplaceTempView("manuals")
    chunks = "text_chunks(TABLE(SELECT doc_id AS id, text FROM manuals))"
    return spark.sql(MANUALS_SQL.format(sales="lot_sales(0.9D)", chunks=chunks))


@query(
    "sql_best_customers",
    f"""WITH {GRAPH_SQL}, counted AS (
  SELECT CAST(supplier_id AS VARCHAR) AS part, customer_id AS key, CAST(count(*) AS DOUBLE) AS score
  FROM pattern WHERE risk_score >= 0.5 GROUP BY ALL)
SELECT part, key, score, row_number() OVER (PARTITION BY part ORDER BY score DESC, key) AS place FROM counted QUALIFY place <= 3""",
)
def sql_best_customers(spark, sf_dir):
    """The three best customers of each risky supplier, from a table function called with PARTITION BY over another one's rows."""
    publish_graph(spark, recall_graph(spark, sf_dir))
    publish_text_functions(spark)
    return spark.sql("""
        SELECT * FROM best_rows(TABLE(
            SELECT CAST(supplier_id AS STRING) AS part, customer_id AS key, CAST(count(*) AS DOUBLE) AS score
            FROM lot_sales(0.5D) GROUP BY supplier_id, customer_id) PARTITION BY (part), 3)""")
