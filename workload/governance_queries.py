"""Masks, row policies, the tag audit and dataset facts over customers and orders."""

from pyspark.sql import functions as F

from aislewise.functions import masks
from aislewise.operators import governance as G
from workload import views as V
from workload.registry import query

ANALYST, LEAD, AUDITOR = "analyst", "lead", "auditor"
POLICIES = {
    "customer_name": G.TagPolicy(frozenset({LEAD}), {ANALYST: "SHA256"}),
    "customer_id": G.TagPolicy(frozenset({LEAD}), {ANALYST: "LAST_FOUR"}),
    "financial_amount": G.TagPolicy(frozenset({LEAD, AUDITOR}), {ANALYST: "DEFAULT"}),
    "email": G.TagPolicy(frozenset({LEAD}), {ANALYST: "EMAIL"}),
    "store_metadata": G.TagPolicy(frozenset({LEAD, ANALYST, AUDITOR})),
}


def customers(spark, sf_dir):
    return G.tag_columns(
        V.table(spark, sf_dir, "customer").withColumn("email", F.concat(F.col("c_name"), F.lit("@mail.example"))),
        {
            "c_name": "customer_name",
            "c_custkey": "customer_id",
            "c_acctbal": "financial_amount",
            "email": "email",
            "c_nationkey": "store_metadata",
        },
    )


def orders(spark, sf_dir):
    return G.tag_columns(
        V.table(spark, sf_dir, "orders"), {"o_custkey": "customer_id", "o_totalprice": "financial_amount"}
    )


def grants():
    return [
        G.RowGrant(frozenset({LEAD}), F.lit(True)),
        G.RowGrant(frozenset({ANALYST}), F.col("c_nationkey").isin(9, 18)),
        G.RowGrant(frozenset({ANALYST}), F.col("c_mktsegment") == "MACHINERY"),
    ]


@query(
    "mask_customers",
    """SELECT 'XXXXX' || right(CAST(c_custkey AS VARCHAR), 4) AS c_custkey, sha256(c_name) AS c_name, c_nationkey,
0e0 AS c_acctbal, c_mktsegment, 'XXXXX@mail.example' AS email FROM customer""",
)
def mask_customers(spark, sf_dir):
    return G.secured_view(customers(spark, sf_dir), ANALYST, POLICIES)


@query(
    "mask_customers_lead",
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, c_name || '@mail.example' AS email FROM customer",
)
def mask_customers_lead(spark, sf_dir):
    return G.secured_view(customers(spark, sf_dir), LEAD, POLICIES, grants())


@query(
    "row_policy",
    """SELECT 'XXXXX' || right(CAST(c_custkey AS VARCHAR), 4) AS c_custkey, sha256(c_name) AS c_name, c_nationkey,
0e0 AS c_acctbal, c_mktsegment, 'XXXXX@mail.example' AS email
FROM customer WHERE c_nationkey IN (9, 18) OR c_mktsegment = 'MACHINERY'""",
)
def row_policy(spark, sf_dir):
    return G.secured_view(customers(spark, sf_dir), ANALYST, POLICIES, grants())


@query("row_policy_default_deny", "SELECT c_nationkey, c_mktsegment FROM customer WHERE FALSE")
def row_policy_default_deny(spark, sf_dir):
    """A persona without a grant sees no rows of the columns it may read."""
    return G.secured_view(customers(spark, sf_dir), AUDITOR, POLICIES, grants(), ["c_nationkey", "c_mktsegment"])


@query("row_policy_attributes", "SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey = 8")
def row_policy_attributes(spark, sf_dir):
    store = V.store_of("c_nationkey")
    mine = G.own_store_or_global(store, "STORE_008", "STORE_MANAGER")
    return V.table(spark, sf_dir, "customer").filter(mine).select("c_custkey", "c_nationkey")


CARD_SQL = "CASE WHEN o_orderstatus = 'P' THEN 'NA' ELSE lpad(CAST(o_orderkey * 7919 AS VARCHAR), 16, '4') END"


@query(
    "mask_cards",
    f"""SELECT o_orderkey, CASE WHEN card = 'NA' THEN 'NA' ELSE 'XXXXXXXXXXXX' || right(card, 4) END AS card_number,
CASE WHEN o_orderpriority = '1-URGENT' THEN card ELSE 'XXXX-XXXX-XXXX-' || right(card, 4) END AS card_for_caller
FROM (SELECT *, {CARD_SQL} AS card FROM orders)""",
)
def mask_cards(spark, sf_dir):
    number = F.lpad((F.col("o_orderkey") * 7919).cast("string"), 16, "4")
    cards = V.table(spark, sf_dir, "orders").withColumn(
        "card", F.when(F.col("o_orderstatus") == "P", "NA").otherwise(number)
    )
    return cards.select(
        "o_orderkey",
        masks.card_number(F.col("card")).alias("card_number"),
        masks.card_number_for(F.col("card"), F.col("o_orderpriority") == "1-URGENT").alias("card_for_caller"),
    )


@query(
    "mask_digests",
    "SELECT c_custkey, sha256(c_name) AS hex_digest, to_base64(unhex(sha256(c_name))) AS base64_digest FROM customer",
)
def mask_digests(spark, sf_dir):
    name = F.col("c_name")
    return V.table(spark, sf_dir, "customer").select(
        "c_custkey",
        masks.sha256_hex(name).alias("hex_digest"),
        masks.sha256_base64(name).alias("base64_digest"),
    )


@query(
    "dataset_facts",
    """SELECT * FROM (
SELECT 'customer' AS table_name, 'NATIVE' AS table_type, 'store-ops' AS owner, TRUE AS contains_pii, 5 AS tagged_columns, count(*) AS row_count FROM customer
UNION ALL SELECT 'orders', 'FEDERATED', 'store-ops', TRUE, 2, count(*) FROM orders
UNION ALL SELECT 'part', 'NATIVE', 'inventory-mgmt', FALSE, 0, count(*) FROM part) WHERE contains_pii""",
)
def dataset_facts(spark, sf_dir):
    facts = G.dataset_facts(
        {
            "customer": (customers(spark, sf_dir), "NATIVE", "store-ops"),
            "orders": (orders(spark, sf_dir), "FEDERATED", "store-ops"),
            "part": (V.table(spark, sf_dir, "part"), "NATIVE", "inventory-mgmt"),
        }
    )
    return facts.filter("contains_pii")
