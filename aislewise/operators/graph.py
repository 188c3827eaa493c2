"""Property graph over tables: patterns are joins, paths are arrays of edges."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aislewise.functions.numbers import ratio
from aislewise.session import cut_lineage

# Risk bands, and the literals that mark a harmful lot.
HIGH_RISK, MODERATE_RISK = 0.75, 0.30
FLAGGED, PASSED = "FLAGGED_HARMFUL_MATERIAL", "PASSED_CLEAN"
EXPOSED = ("TRUE", "CONTAMINATED_HARMFUL")
VIP_TIERS = ("PLATINUM", "GOLD")
# Nodes of so many bytes are sent to every task.
SMALL_BYTES = 64 << 20


def _long(table: str, counts: DataFrame) -> DataFrame:
    """One row per rule from one row of counts."""
    rules = [F.struct(F.lit(c).alias("rule"), F.col(c).alias("violations")) for c in counts.columns]
    return counts.select(F.lit(table).alias("table_name"), F.inline(F.array(*rules)))


@dataclass(frozen=True)
class Slim:
    """The columns that a table's own are computed from. Joins of whole tables move these only; ``made`` computes the others after
    the last join: it is given a function from a column's name to the column, and gives the table's columns by name.

    ``keys`` names the columns that stand for a key of the table: two rows have the same key where these are equal, and none where
    one of them is NULL. Both ends of an edge list theirs in the same order. ``head`` is a table of what many edges share, such as
    the order of its lines, with the column of the edges and its own that meet; it holds their targets."""

    table: DataFrame
    made: Callable[[Callable[[str], Column]], dict[str, Column]]
    keys: dict[str, tuple[str, ...]]
    head: tuple[DataFrame, str, str] | None = None

    def full(self) -> DataFrame:
        rows = self.table
        if self.head:
            shared, at, key = self.head
            rows = rows.join(shared, F.col(at) == F.col(key))
        return rows.select(*[c.alias(name) for name, c in self.made(F.col).items()])


def _slim(part: Nodes | Edges) -> Slim:
    """A table without a slim form is its own."""
    return part.slim or Slim(part.table, lambda c: {name: c(name) for name in part.table.columns}, {})


@dataclass(frozen=True)
class Nodes:
    table: DataFrame
    key: str
    slim: Slim | None = None


@dataclass(frozen=True)
class Edges:
    """An edge table; ``source`` and ``target`` are (column, node label)."""

    table: DataFrame
    key: str
    source: tuple[str, str]
    target: tuple[str, str]
    slim: Slim | None = None


@dataclass(frozen=True)
class PropertyGraph:
    nodes: dict[str, Nodes]
    edges: dict[str, Edges]

    def row_counts(self) -> DataFrame:
        """Rows of every node and edge table."""
        named = [(n, t.table) for n, t in [*self.nodes.items(), *self.edges.items()]]
        counts = [t.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n, t in named]
        return reduce(DataFrame.unionByName, counts)

    def violations(self) -> DataFrame:
        """Repeated or missing keys, and edges that point at no node, counted per table and rule."""
        found = []
        for name, part in [*self.nodes.items(), *self.edges.items()]:
            keys = part.table.groupBy(F.col(part.key).alias("k")).agg(F.count(F.lit(1)).alias("n"))
            known = F.col("k").isNotNull()
            counts = keys.agg(
                F.count_if(known & (F.col("n") > 1)).alias("key_not_unique"),
                F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("key_missing"),
            )
            found.append(_long(name, counts))
        for name, e in self.edges.items():
            for rule, (col, label) in (("source_not_found", e.source), ("target_not_found", e.target)):
                node = self.nodes[label]
                known = node.table.select(F.col(node.key).alias("known"))
                # Ends are counted before the join, so a hub joins as one row.
                ends = e.table.groupBy(F.col(col).alias("end")).agg(F.count(F.lit(1)).alias("n"))
                dangling = ends.join(known, F.col("end") == F.col("known"), "left_anti")
                found.append(_long(name, dangling.agg(F.coalesce(F.sum("n"), F.lit(0)).alias(rule))))
        return reduce(DataFrame.unionByName, found)

    def node(self, label: str, prefix: str, where: Column | None = None) -> DataFrame:
        """A node table with prefixed columns. Filters name the plain columns, so they reach the scan."""
        t = self.nodes[label].table
        t = t if where is None else t.filter(where)
        return t.select(*[F.col(c).alias(f"{prefix}_{c}") for c in t.columns])

    def edge(self, label: str, prefix: str, where: Column | None = None) -> DataFrame:
        t = self.edges[label].table
        t = t if where is None else t.filter(where)
        return t.select(*[F.col(c).alias(f"{prefix}_{c}") for c in t.columns])

    def step(
        self,
        left: DataFrame,
        left_prefix: str,
        edge: str,
        edge_prefix: str,
        right: DataFrame,
        right_prefix: str,
        right_first: bool = False,
    ) -> DataFrame:
        """``(left)-[edge]->(right)``: two equi joins. With ``right_first`` edges meet their right ends first, so that the columns
        of ``left`` are not shuffled for these: fewer bytes where the left side is wide and drops no edges."""
        e = self.edges[edge]
        src = f"{left_prefix}_{self.nodes[e.source[1]].key}"
        dst = f"{right_prefix}_{self.nodes[e.target[1]].key}"
        hop = self.edge(edge, edge_prefix)
        at_left, at_right = F.col(src) == F.col(f"{edge_prefix}_{e.source[0]}"), F.col(dst) == F.col(f"{edge_prefix}_{e.target[0]}")
        if right_first:
            return left.join(hop.join(right, at_right), at_left)
        return left.join(hop, at_left).join(right, at_right)


def reaching(ends: DataFrame, edges: DataFrame, onward: DataFrame, low: int, high: int) -> list[DataFrame]:
    """For each number of hops walked so far, from 1 to ``high``, the nodes from which some walk can still end rightly: after as
    many more hops as bring it between ``low`` and ``high``. Distinct nodes, found backwards from ``ends``, one semi-join a hop."""
    steps = [ends.select("id").distinct()]
    for _ in range(high - 1):
        back = onward.join(steps[-1].withColumnRenamed("id", "dst"), "dst", "left_semi")
        steps.append(cut_lineage(back.select(F.col("src").alias("id")).distinct()))
    live = []
    for walked in range(1, high + 1):
        left = steps[max(low - walked, 0) : high - walked + 1]
        live.append(left[0] if len(left) == 1 else reduce(DataFrame.unionByName, left).distinct())
    return live


def walks(
    start: DataFrame,
    edges: DataFrame,
    ends: DataFrame,
    low: int,
    high: int,
    *,
    onward: DataFrame | None = None,
    checkpoint: bool = False,
) -> DataFrame:
    """Every walk of ``low`` to ``high`` edges from a start node to an end node.

    ``onward`` are the edges that hops after the first may take, where they start from another kind of node than the
    first: a small list of lanes between stores, say, in place of all shipments.

    ``start`` and ``ends`` have a column ``id``; ``edges`` has ``edge_id``, ``src`` and ``dst``. One row
    per walk, nodes and edges may repeat. Each hop is one equi join with the edges that can still lead to an end in the hops
    left, so a walk that is carried on is part of a result. Long walks over dense graphs should cut the plan at each hop.
    An edge becomes JSON once, before the joins; where only the text is asked for, no array is built.
    """
    link = F.struct(F.col("src"), F.col("edge_id"), F.col("dst"))
    later = edges if onward is None else onward
    live = reaching(ends, edges, later, low, high)

    def hop(taken: DataFrame, walked: int) -> DataFrame:
        useful = live[walked - 1].withColumnRenamed("id", "dst")
        return taken.join(useful, "dst", "left_semi").select("src", "dst", link.alias("link"), F.to_json(link).alias("text"))

    frontier = start.select("id").join(hop(edges, 1), F.col("id") == F.col("src")).select(
        F.col("id").alias("start_id"), F.col("dst").alias("end_id"), F.array("link").alias("path"), F.col("text").alias("steps")
    )
    last = ends.select(F.col("id").alias("end_id")).distinct()
    found = []
    for length in range(1, high + 1):
        if length > 1:
            frontier = frontier.join(hop(later, length), F.col("end_id") == F.col("src")).select(
                "start_id",
                F.col("dst").alias("end_id"),
                F.concat("path", F.array("link")).alias("path"),
                F.concat("steps", F.lit(","), "text").alias("steps"),
            )
        if checkpoint and length > 1:
            frontier = cut_lineage(frontier)
        if length >= low:
            # At the last length, all that is left are ends.
            done = frontier if length == high else frontier.join(last, "end_id", "left_semi")
            found.append(
                done.select(
                    "start_id",
                    "end_id",
                    "path",
                    F.lit(length).alias("hops"),
                    F.concat(F.lit("["), "steps", F.lit("]")).alias("path_json"),
                )
            )
    return reduce(DataFrame.unionByName, found)


def walk_counts(start: DataFrame, edges: DataFrame, ends: DataFrame, low: int, high: int, *, onward: DataFrame | None = None) -> DataFrame:
    """(start_id, end_id, hops, walks): how many walks there are, without any of them. A hop adds up the walks that meet in a
    node, so the rows are pairs of nodes, however many walks join them."""
    later = edges if onward is None else onward
    live = reaching(ends, edges, later, low, high)
    last = ends.select(F.col("id").alias("end_id")).distinct()
    ways = start.select(F.col("id").alias("start_id"), F.col("id").alias("at"), F.lit(1).cast("long").alias("walks"))
    found = []
    for length in range(1, high + 1):
        taken = (edges if length == 1 else later).join(live[length - 1].withColumnRenamed("id", "dst"), "dst", "left_semi")
        # Parallel edges are counted before the join.
        links = taken.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))
        met = ways.join(links, F.col("at") == F.col("src")).groupBy("start_id", "dst")
        ways = cut_lineage(met.agg(F.sum(F.col("walks") * F.col("n")).alias("walks")).withColumnRenamed("dst", "at"))
        if length >= low:
            done = ways.withColumnRenamed("at", "end_id").withColumn("hops", F.lit(length))
            found.append(done.join(last, "end_id", "left_semi").select("start_id", "end_id", "hops", "walks"))
    return reduce(DataFrame.unionByName, found)


def flagged_lot(prefix: str = "lot") -> Column:
    return F.col(f"{prefix}_qa_inspection_status") == FLAGGED


def active_recall(lot: str = "lot", sale: str = "sale") -> Column:
    """An ``OR`` over nullable columns: unknown stays NULL unless one arm is true."""
    exposure = F.col(f"{sale}_exposure_flag")
    return (
        flagged_lot(lot)
        | F.col(f"{lot}_recall_status").like("%RECALL%")
        | (exposure == EXPOSED[0])
        | (exposure == EXPOSED[1])
    )


def risk_band(score: Column) -> Column:
    return (
        F.when(score >= HIGH_RISK, "CRITICAL_HIGH_RISK").when(score >= MODERATE_RISK, "MODERATE_RISK").otherwise("LOW_RISK")
    )


def sales_of_lots(g: PropertyGraph, supplier: Column | None = None, lot: Column | None = None, customer: Column | None = None) -> DataFrame:
    """``(sup)-[PRODUCED_BATCH]->(lot)-[sale]->(cust)`` with every node's filter below its join."""
    sup, lots, cust = g.node("Supplier", "sup", supplier), g.node("BatchLot", "lot", lot), g.node("Customer", "cust", customer)
    made = g.step(sup, "sup", "PRODUCED_BATCH", "made", lots, "lot")
    return g.step(made, "lot", "PURCHASED_LOT_BY_CUSTOMER", "sale", cust, "cust", right_first=supplier is None and lot is None)


def sales_of_all_lots(g: PropertyGraph, small_bytes: int = SMALL_BYTES) -> DataFrame:
    """The rows and columns of ``sales_of_lots`` without a filter, for results that are wanted whole.

    Joins move slim columns, and the tables' own are computed after the last of them; a filter on those would not reach the scans.
    Customers meet the heads of sales, where there are any, and these the sales of lots last. Suppliers, where they are measured to
    be small, are sent to every task at the end, so neither are edges dealt out by supplier nor do suppliers' columns travel."""
    parts = {
        "sup": g.nodes["Supplier"], "made": g.edges["PRODUCED_BATCH"], "lot": g.nodes["BatchLot"],
        "sale": g.edges["PURCHASED_LOT_BY_CUSTOMER"], "cust": g.nodes["Customer"],
    }
    slim = {p: _slim(part) for p, part in parts.items()}
    named = lambda p, df: df.select(*[F.col(c).alias(f"{p}_{c}") for c in df.columns])
    moved = {p: named(p, s.table) for p, s in slim.items()}
    heads = {p: named(p, s.head[0]) for p, s in slim.items() if s.head}
    types = dict(pair for df in [*moved.values(), *heads.values()] for pair in df.dtypes)
    equal: dict[str, str] = {}  # what a join makes equal is carried on once

    def own(p: str) -> dict[str, Column]:
        return slim[p].made(lambda c: F.col(equal.get(f"{p}_{c}", f"{p}_{c}")))

    def same(left: str, left_key: str, right: str, right_key: str) -> Column:
        a, b = slim[left].keys.get(left_key, ()), slim[right].keys.get(right_key, ())
        if not a or len(a) != len(b):
            return own(left)[left_key] == slim[right].made(lambda c: F.col(f"{right}_{c}"))[right_key]
        pairs = [(equal.get(f"{left}_{x}", f"{left}_{x}"), f"{right}_{y}") for x, y in zip(a, b, strict=True)]
        equal.update({y: x for x, y in pairs if types[x] == types[y]})
        return reduce(Column.__and__, [F.col(x) == F.col(y) for x, y in pairs])

    made, sale = parts["made"], parts["sale"]
    few = _bytes(moved["sup"]) <= small_bytes
    first = moved["made"] if few else moved["sup"].join(moved["made"], same("made", made.source[0], "sup", parts["sup"].key))
    lots = first.join(moved["lot"], same("made", made.target[0], "lot", parts["lot"].key))
    bought, to_customer = same("lot", parts["lot"].key, "sale", sale.source[0]), same("sale", sale.target[0], "cust", parts["cust"].key)
    if slim["sale"].head:
        _, at, key = slim["sale"].head
        bought_with = heads["sale"].join(moved["cust"], to_customer)
        met = lots.join(moved["sale"], bought).join(bought_with, F.col(f"sale_{at}") == F.col(f"sale_{key}"))
    else:
        met = lots.join(moved["sale"].join(moved["cust"], to_customer), bought)
    if few:
        met = met.join(F.broadcast(moved["sup"]), same("made", made.source[0], "sup", parts["sup"].key))
    return met.select(*[c.alias(f"{p}_{name}") for p in parts for name, c in own(p).items()])


def _bytes(df: DataFrame) -> int:
    """About as many as the rows take in memory."""
    row = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in df.columns]
    return df.agg(F.sum(reduce(Column.__add__, row))).first()[0] or 0


def vip_recall(g: PropertyGraph) -> DataFrame:
    """Loyal customers who hold a suspect lot of a high-risk supplier."""
    hit = sales_of_lots(g, F.col("risk_score") >= HIGH_RISK, None, F.col("loyalty_tier").isin(*VIP_TIERS))
    suspect = (
        flagged_lot() | F.col("lot_recall_status").like("%RECALL%") | (F.col("sale_exposure_flag") == EXPOSED[1])
    )
    return hit.filter(suspect).select(
        F.col("cust_customer_id").alias("customer_id"),
        F.col("cust_name").alias("customer_name"),
        F.col("cust_loyalty_tier").alias("loyalty_tier"),
        F.col("cust_email").alias("email"),
        F.col("cust_phone_number").alias("phone_number"),
        F.col("cust_global_region").alias("customer_region"),
        F.col("lot_harmful_material_defect").alias("defect_description"),
        F.col("sale_purchase_timestamp").alias("purchase_timestamp"),
        F.col("lot_batch_id").alias("batch_id"),
        F.col("lot_item_id").alias("item_id"),
        F.col("lot_item_name").alias("item_name"),
        F.col("lot_recall_status").alias("recall_status"),
        F.col("sale_serial_number").alias("serial_number"),
        F.col("sale_transaction_id").alias("transaction_id"),
        F.col("sup_supplier_id").alias("supplier_id"),
        F.col("sup_facility_name").alias("supplier_facility"),
        F.col("sup_risk_score").alias("supplier_risk_score"),
    )


def vip_order(df: DataFrame) -> DataFrame:
    """Tier descending is lexical: PLATINUM before GOLD."""
    return df.orderBy(F.desc("loyalty_tier"), F.desc("supplier_risk_score"), "customer_name", "transaction_id", "serial_number")


def co_exposure(g: PropertyGraph, index_customer: Column) -> DataFrame:
    """Customers exposed through the same high-risk supplier as one index customer.

    ``(c1)<-(b1)<-(sup)->(b2)->(c2)``, with ``b1`` free to equal ``b2``. The walk starts at the one
    customer, so the frontier is that customer's lots and their suppliers, never all pairs.
    """
    seen = sales_of_lots(g, F.col("risk_score") >= HIGH_RISK, None, F.col("customer_id") == index_customer).select(
        F.col("cust_customer_id").alias("index_customer_id"),
        F.col("cust_name").alias("index_customer_name"),
        F.col("lot_batch_id").alias("index_batch_id"),
        F.col("lot_item_name").alias("index_product_name"),
        F.col("sup_supplier_id").alias("supplier_id"),
        F.col("sup_facility_name").alias("common_supplier_facility"),
        F.col("sup_risk_score").alias("supplier_risk_score"),
    )
    made = g.edges["PRODUCED_BATCH"]
    lots2 = seen.join(
        made.table.select(F.col(made.source[0]).alias("made_by"), F.col(made.target[0]).alias("secondary_batch_id")),
        F.col("made_by") == F.col("supplier_id"),
    )
    sold = g.edges["PURCHASED_LOT_BY_CUSTOMER"]
    sales2 = sold.table.select(
        F.col(sold.source[0]).alias("sold_lot"), F.col(sold.target[0]).alias("secondary_customer_id")
    ).filter(F.col("secondary_customer_id") != index_customer)
    cust2, lot2 = g.node("Customer", "c2"), g.node("BatchLot", "b2").select("b2_batch_id", "b2_item_name")
    return (
        lots2.join(lot2, F.col("b2_batch_id") == F.col("secondary_batch_id"))
        .join(sales2, F.col("sold_lot") == F.col("secondary_batch_id"))
        .join(cust2, F.col("c2_customer_id") == F.col("secondary_customer_id"))
        .select(
            "index_customer_id",
            "index_customer_name",
            "index_batch_id",
            "index_product_name",
            "supplier_id",
            "common_supplier_facility",
            "supplier_risk_score",
            "secondary_batch_id",
            F.col("b2_item_name").alias("secondary_product_name"),
            "secondary_customer_id",
            F.col("c2_name").alias("secondary_customer_name"),
            F.col("c2_loyalty_tier").alias("secondary_loyalty_tier"),
            F.col("c2_email").alias("secondary_email"),
            F.col("c2_phone_number").alias("secondary_phone_number"),
        )
    )


def recall_contacts(g: PropertyGraph, batch_id: Column) -> DataFrame:
    """Who bought a flagged lot, newest purchase first."""
    lots = g.node("BatchLot", "lot", (F.col("batch_id") == batch_id) & (F.col("qa_inspection_status") == FLAGGED))
    hit = g.step(lots, "lot", "PURCHASED_LOT_BY_CUSTOMER", "sale", g.node("Customer", "cust"), "cust")
    return hit.select(
        F.col("lot_batch_id").alias("batch_id"),
        F.col("lot_item_name").alias("item_name"),
        F.col("cust_customer_id").alias("customer_id"),
        F.col("cust_name").alias("customer_name"),
        F.col("cust_loyalty_tier").alias("loyalty_tier"),
        F.col("cust_email").alias("email"),
        F.col("cust_phone_number").alias("phone_number"),
        F.col("cust_global_region").alias("customer_region"),
        F.col("lot_harmful_material_defect").alias("defect_description"),
        F.col("sale_unit_price_usd").alias("unit_price_usd"),
        F.col("sale_store_id").alias("store_id"),
        F.col("sale_transaction_id").alias("transaction_id"),
        F.col("sale_purchase_timestamp").alias("purchase_timestamp"),
        F.col("sale_serial_number").alias("serial_number"),
    ).orderBy(F.desc("purchase_timestamp"), "transaction_id", "serial_number")


def supplier_scorecard(g: PropertyGraph) -> DataFrame:
    """Lots, clean and flagged lots, and defect rate per supplier, worst first."""
    made = g.step(g.node("Supplier", "sup"), "sup", "PRODUCED_BATCH", "made", g.node("BatchLot", "lot"), "lot")
    n = F.count("lot_batch_id")
    return (
        made.groupBy(
            F.col("sup_supplier_id").alias("supplier_id"),
            F.col("sup_facility_name").alias("facility_name"),
            F.col("sup_country").alias("country"),
            F.col("sup_risk_score").alias("risk_score"),
        )
        .agg(
            n.alias("total_lots_produced"),
            F.count_if(F.col("lot_qa_inspection_status") == PASSED).alias("passed_clean_lots"),
            F.count_if(flagged_lot()).alias("flagged_harmful_lots"),
            F.round(ratio(100.0 * F.count_if(flagged_lot()), n), 2).alias("defect_rate_pct"),
        )
        .orderBy(F.desc("defect_rate_pct"), F.desc("total_lots_produced"), "supplier_id")
    )


def recall_360(g: PropertyGraph, stores: DataFrame, whole: bool = False) -> DataFrame:
    """Every sold unit with its lot, supplier, customer, recall flag, risk band and, if known, its store. ``whole``: the view is
    wanted as it is, and no filter on it would have to reach the scans."""
    s = stores.select(*[F.col(c).alias(f"s_{c}") for c in ("store_id", "store_name", "city", "country", "region")])
    return (
        (sales_of_all_lots(g) if whole else sales_of_lots(g))
        .join(s, F.col("sale_store_id") == F.col("s_store_id"), "left")
        .select(
            F.col("sale_transaction_id").alias("transaction_id"),
            F.col("sale_serial_number").alias("hardware_serial_number"),
            F.col("sale_purchase_timestamp").alias("purchase_timestamp"),
            F.col("lot_item_id").alias("product_sku"),
            F.col("lot_item_name").alias("product_name"),
            F.col("sale_unit_price_usd").alias("unit_price_usd"),
            F.col("sale_currency").alias("currency"),
            active_recall().alias("is_active_recall"),
            F.col("lot_qa_inspection_status").alias("qa_inspection_status"),
            F.col("lot_harmful_material_defect").alias("defect_description"),
            F.col("lot_recall_status").alias("batch_recall_status"),
            risk_band(F.col("sup_risk_score")).alias("supplier_risk_category"),
            F.col("sup_supplier_id").alias("supplier_id"),
            F.col("sup_facility_name").alias("supplier_facility"),
            F.col("sup_country").alias("supplier_country"),
            F.col("sup_risk_score").alias("supplier_risk_score"),
            F.col("sup_certified").alias("is_supplier_certified"),
            F.col("lot_batch_id").alias("batch_id"),
            F.col("lot_manufacturing_date").alias("manufacturing_date"),
            F.col("sale_store_id").alias("store_id"),
            F.col("s_store_name").alias("store_name"),
            F.col("s_city").alias("store_city"),
            F.col("s_country").alias("store_country"),
            F.col("s_region").alias("store_region"),
            F.col("cust_customer_id").alias("customer_id"),
            F.col("cust_name").alias("customer_name"),
            F.col("cust_loyalty_tier").alias("customer_loyalty_tier"),
            F.col("cust_email").alias("customer_email"),
            F.col("cust_phone_number").alias("customer_phone"),
            F.col("cust_global_region").alias("customer_region"),
        )
    )


def dispatch(view_360: DataFrame, batch_id: Column) -> DataFrame:
    """Units to call back now, from the 360 view."""
    return (
        view_360.filter(F.col("is_active_recall") & (F.col("batch_id") == batch_id))
        .select(
            "transaction_id", "hardware_serial_number", "product_name", "batch_id", "customer_id", "customer_name",
            "customer_loyalty_tier", "customer_email", "customer_phone", "store_id", "store_name", "store_city",
            "store_country", "is_active_recall", "supplier_risk_category", "purchase_timestamp",
        )
        .orderBy(F.desc("purchase_timestamp"), "transaction_id", "hardware_serial_number")
    )
