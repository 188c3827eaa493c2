"""Row keys, identifiers, cells, fault tags, incremental embedding and the load gate."""

from pyspark.sql import functions as F

from aislewise.functions import keys, text
from aislewise.operators import search as S
from aislewise.operators.ledger import silver_sales
from aislewise.plans.nightly import expected_positions
from aislewise.streaming.events import lateness
from workload import views as V
from workload.ledger_queries import POSITIONS_SQL, SETTINGS
from workload.registry import query
from workload.sales_queries import ALERTS_SQL, AS_OF, CHECKOUTS_SQL, as_of


@query(
    "alert_keys",
    f"""WITH {ALERTS_SQL} SELECT alert_id, '0' || substr(md5(store_id), 1, 1) || '#STORE#' || store_id || '#ALERT#'
|| lpad(CAST(9999999999999 - epoch_us(alert_ts) // 1000 AS VARCHAR), 13, '0') AS row_key FROM alerts""",
)
def alert_keys(spark, sf_dir):
    return V.alerts(spark, sf_dir).select("alert_id", keys.alert_key(F.col("store_id"), F.col("alert_ts")).alias("row_key"))


@query(
    "stock_keys",
    """SELECT DISTINCT '0' || substr(md5(store), 1, 1) || '#STORE#' || store || '#SKU#' || event_type AS row_key
FROM (SELECT printf('STORE_%03d', user_id) AS store, event_type FROM events)""",
)
def stock_keys(spark, sf_dir):
    pairs = V.inventory(spark, sf_dir)
    return pairs.select(keys.stock_key(F.col("store_id"), F.col("item_id")).alias("row_key"))


@query(
    "normalised_ids",
    """SELECT c_custkey, printf('STORE_%03d', CAST(regexp_replace(c_name, '[^0-9]', '', 'g') AS BIGINT)) AS store_id,
'CASH_' || regexp_replace(c_name, '[^0-9]', '', 'g') AS cashier_id, c_mktsegment AS no_digits,
'STORE_' || (CAST(9000000000000000000 AS HUGEINT) + c_custkey) AS long_id FROM customer""",
)
def normalised_ids(spark, sf_dir):
    return V.table(spark, sf_dir, "customer").select(
        "c_custkey",
        text.store_key(F.col("c_name")).alias("store_id"),
        text.cashier_key(F.col("c_name")).alias("cashier_id"),
        text.store_key(F.col("c_mktsegment")).alias("no_digits"),
        text.store_key(F.concat(F.lit("Store 0"), F.lit(9 * 10**18) + F.col("c_custkey"))).alias("long_id"),
    )


@query(
    "serving_cells",
    """SELECT event_id, lpad(printf('%X', event_id), 16, '0') AS int_cell, event_id AS int_value, value AS float_value,
event_type AS text_value FROM events""",
)
def serving_cells(spark, sf_dir):
    """Values written as big-endian cells and read back."""
    e = V.table(spark, sf_dir, "events").select(
        "event_id",
        keys.encode_int64(F.col("event_id")).alias("i"),
        keys.encode_float64(F.col("value")).alias("f"),
        keys.encode_text(F.col("event_type")).alias("t"),
    )
    return e.select(
        "event_id",
        F.hex("i").alias("int_cell"),
        keys.decode_int64(F.col("i")).alias("int_value"),
        keys.decode_float64(F.col("f")).alias("float_value"),
        keys.decode_text(F.col("t")).alias("text_value"),
    )


@query(
    "fault_tags",
    r"""SELECT source, count(*) AS documents,
count(*) FILTER (regexp_matches(text, 'ERR[-_](PAY|SYNC|NET|PRN|INV)[-_]\d{3,4}')) AS naming_a_fault,
count(*) FILTER (regexp_matches(text, '[A-Za-z0-9]+-[A-Za-z0-9-]+')) AS naming_a_code FROM documents GROUP BY 1""",
)
def fault_tags(spark, sf_dir):
    body = F.col("text")
    return V.table(spark, sf_dir, "documents").groupBy("source").agg(
        F.count(F.lit(1)).alias("documents"),
        F.count_if(text.names_fault(body)).alias("naming_a_fault"),
        F.count_if(body.rlike(text.CODE_PATTERN)).alias("naming_a_code"),
    )


@query(
    "new_embeddings",
    """SELECT doc_id, '' AS status, 256 AS dimensions FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
)
def new_embeddings(spark, sf_dir):
    """Embed only what is not embedded yet; the labelled documents stand for those that are."""
    docs = V.texts(spark, sf_dir, "documents", "doc_id").select("doc_id", "text")
    done = V.table(spark, sf_dir, "labels").select("doc_id")
    fresh = S.new_embeddings(docs, done, "doc_id", F.col("text"))
    return fresh.select("doc_id", "embedding.status", F.size("embedding.result").alias("dimensions"))


@query(
    "event_lateness",
    f"""WITH {CHECKOUTS_SQL} SELECT CAST(floor((epoch_ms(TIMESTAMP '{AS_OF}') // 1000
  - epoch_ms(date_trunc('second', event_ts)) // 1000) / 60) AS BIGINT) AS minutes_late, count(*) AS events
FROM checkouts GROUP BY 1""",
)
def event_lateness(spark, sf_dir):
    return lateness(V.checkouts(spark, sf_dir), as_of())


@query("load_gate", f"WITH {POSITIONS_SQL} SELECT count(*) AS positions FROM positions")
def load_gate(spark, sf_dir):
    """The number of rows the nightly job must find in its ledger."""
    dates = silver_sales(V.bronze_events(spark, sf_dir), SETTINGS).dates
    return expected_positions(V.inventory(spark, sf_dir), V.stores(spark, sf_dir), dates)
