"""Queries for operators whose work shows in tables, plans and schemas: round trips, denials, verdicts and planted faults."""

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from aislewise.operators import documents as D
from aislewise.operators import governance as G
from aislewise.operators import ledger as L
from aislewise.operators import quality as Q
from aislewise.plans import guards
from aislewise.session import shared_dir
from aislewise.sources import sinks, tables
from aislewise.streaming import scoring, windows
from workload import views as V
from workload.document_queries import PAGES_SQL, page_documents
from workload.governance_queries import ANALYST, AUDITOR, LEAD, POLICIES, customers, orders
from workload.ledger_queries import SETTINGS
from workload.registry import query
from workload.sales_queries import CHECKOUTS_SQL
from workload.stream_queries import METRICS_SQL, RULE_SQL


def _folder(spark, name):
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


# Reads and writes.


@query(
    "table_round_trip",
    "SELECT o_orderstatus, count(*) AS orders, count(*) FILTER (o_orderkey % 3 = 0) AS inserted, min(o_orderkey) AS first_order FROM orders GROUP BY 1",
)
def table_round_trip(spark, sf_dir):
    """Orders written as a catalog table and as inserts into it, and read back by the first of three names that exists."""
    name = f"orders_{uuid.uuid4().hex}"
    o = V.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    sinks.create_table_as(o.where("o_orderkey % 3 <> 0"), name)
    sinks.insert_select(o.where("o_orderkey % 3 = 0").select("o_custkey", "o_orderstatus", "o_orderkey"), name)
    back = tables.read_table(spark, [f"{sf_dir}/none.parquet", f"no-project:none.{name}", name], ["o_orderkey", "o_orderstatus"])
    return back.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("orders"), F.count_if(F.col("o_orderkey") % 3 == 0).alias("inserted"), F.min("o_orderkey").alias("first_order")
    )


@query(
    "dated_sources",
    """SELECT 'pos' AS source, CAST(ts AS DATE) AS business_date, count(*) AS n_rows FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-12' GROUP BY ALL
UNION ALL SELECT 'inventory', NULL, count(*) FROM part UNION ALL SELECT 'stores', NULL, count(*) FROM supplier""",
)
def dated_sources(spark, sf_dir):
    """The ledger's three inputs, of which only the sales are limited by date, at partitions of the written table."""
    path = _folder(spark, "pos")
    events = V.table(spark, sf_dir, "events").withColumn("business_date", F.to_date("ts"))
    sinks.write_dated(events, path)
    read = tables.read_sources(
        spark, [path], [f"{sf_dir}/none.parquet", f"{sf_dir}/part.parquet"], [f"{sf_dir}/supplier.parquet"], "2024-01-05", "2024-01-12"
    )
    n = F.count(F.lit(1)).alias("n_rows")
    out = read.pos.groupBy(F.lit("pos").alias("source"), "business_date").agg(n)
    for name, df in (("inventory", read.inventory), ("stores", read.stores)):
        out = out.unionByName(df.agg(n).select(F.lit(name).alias("source"), F.lit(None).cast("date").alias("business_date"), "n_rows"))
    return out


@query(
    "lasting_view",
    "SELECT o_orderpriority, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total FROM orders GROUP BY 1",
)
def lasting_view(spark, sf_dir):
    """A view in the catalog over a written table; it outlasts the DataFrame that it was made from."""
    name = f"orders_{uuid.uuid4().hex}"
    sinks.create_table_as(V.table(spark, sf_dir, "orders"), name)
    sinks.create_view(
        spark,
        f"{name}_view",
        f"SELECT o_orderpriority, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total FROM {name} GROUP BY 1",
    )
    return spark.table(f"{name}_view")


@query(
    "exported_results",
    """SELECT rule_id, CAST(scanned AS TIMESTAMP) AS scanned_at, value, ok FROM (VALUES ('2026-01-01'), ('2026-01-02')) AS d(scanned), (
  SELECT 'total_positive' AS rule_id, count(*) FILTER (o_totalprice > 0) / CAST(count(*) AS DOUBLE) AS value,
         count(*) FILTER (o_totalprice > 0) = count(*) AS ok FROM orders
  UNION ALL SELECT 'status_final', count(*) FILTER (o_orderstatus = 'F') / CAST(count(*) AS DOUBLE),
         count(*) FILTER (o_orderstatus = 'F') = count(*) FROM orders)""",
)
def exported_results(spark, sf_dir):
    """Two scans of the orders, appended to the table of results."""
    path = _folder(spark, "scans")
    rules = [Q.holds("total_positive", "validity", F.col("o_totalprice") > 0), Q.holds("status_final", "validity", F.col("o_orderstatus") == "F")]
    results = Q.evaluate(V.table(spark, sf_dir, "orders"), "orders", rules)
    for day in ("2026-01-01", "2026-01-02"):
        Q.export_results(results, path, day)
    return spark.read.parquet(path).select("rule_id", "scanned_at", "value", "ok")


@query(
    "object_files",
    "SELECT CAST(n_nationkey AS VARCHAR) AS document, CAST(length(n_name) + 1 AS BIGINT) AS n_bytes, n_name || chr(10) AS content FROM nation",
)
def object_files(spark, sf_dir):
    """Nations written as one text file each, listed as objects with their sizes and bytes."""
    root = _folder(spark, "objects")
    V.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("value")).repartition("k").write.partitionBy("k").text(root)
    files = D.file_corpus(spark, root, "txt", content=True)
    return files.select(
        F.regexp_extract("uri", "/k=([0-9]+)/", 1).alias("document"), "n_bytes", F.col("content").cast("string").alias("content")
    )


@query(
    "feed_columns",
    "SELECT o_orderkey AS transaction_id, o_custkey AS store_id, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS note FROM orders",
)
def feed_columns(spark, sf_dir):
    """A feed that spells its columns in another case, with one more and an optional one."""
    feed = V.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("Transaction_ID"), F.col("o_custkey").alias("STORE_id"), F.col("o_totalprice").alias("unused"),
        F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority")).alias("NOTE"),
    )
    return L.resolve(feed, ["transaction_id", "store_id"], ["note", "comment"])


# Schemas, rules and their links.

CONTRACT = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_clerk", T.StringType()), T.StructField("o_orderstatus", T.StringType(), False),
    ]
)


@query(
    "schema_differences",
    """WITH live AS (
  SELECT column_name AS path, CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string'
    ELSE 'timestamp' END AS live_type FROM information_schema.columns WHERE table_name = 'orders'
), contract(path, contract_type, may_be_null) AS (
  VALUES ('o_orderkey', 'bigint', TRUE), ('o_custkey', 'string', TRUE), ('o_totalprice', 'double', TRUE), ('o_clerk', 'string', TRUE),
         ('o_orderstatus', 'string', FALSE)
)
SELECT path, contract_type, live_type, CASE WHEN live_type IS NULL THEN 'MISSING' WHEN contract_type IS NULL THEN 'EXTRA'
  WHEN contract_type <> live_type THEN 'TYPE' WHEN NOT may_be_null THEN 'MODE' ELSE 'OK' END AS issue
FROM live FULL JOIN contract USING (path)""",
)
def schema_differences(spark, sf_dir):
    """The orders' schema against a contract that differs in every way."""
    live = V.table(spark, sf_dir, "orders").schema
    plain = T.StructType([T.StructField(f.name, T.TimestampType() if f.dataType.typeName().startswith("timestamp") else f.dataType) for f in live])
    return Q.schema_diff(spark, CONTRACT, plain).select("path", "contract_type", "live_type", "issue")


@query(
    "rule_linkage",
    """WITH rules AS (
  SELECT p_brand AS contract, 'R' || p_partkey AS rule_id, p_type AS dimension, p_partkey % 3 = 0 AS required FROM part
), assertions AS (
  SELECT p_brand AS contract, 'R' || p_partkey AS rule_id, CASE WHEN p_partkey % 11 = 0 THEN 'other' ELSE p_type END AS dimension
  FROM part WHERE p_partkey % 5 <> 0
  UNION ALL SELECT p_brand, 'R' || p_partkey, p_type FROM part WHERE p_partkey % 14 = 1
  UNION ALL SELECT p_brand, 'X' || p_partkey, p_type FROM part WHERE p_partkey % 13 = 0
)
SELECT contract, rule_id, 'RULE_WITHOUT_ASSERTION' AS issue FROM rules WHERE required AND (contract, rule_id) NOT IN (SELECT (contract, rule_id) FROM assertions)
UNION ALL SELECT contract, rule_id, 'ASSERTION_WITHOUT_RULE' FROM assertions WHERE (contract, rule_id) NOT IN (SELECT (contract, rule_id) FROM rules)
UNION ALL SELECT contract, rule_id, 'REPEATED_ASSERTION' FROM assertions GROUP BY ALL HAVING count(*) > 1
UNION ALL SELECT a.contract, a.rule_id, 'DIMENSION_DIFFERS' FROM assertions a JOIN rules r USING (contract, rule_id) WHERE a.dimension <> r.dimension""",
)
def rule_linkage(spark, sf_dir):
    """A rule for every part, and assertions of which some are missing, repeated, without a rule or of another dimension."""
    part, key = V.table(spark, sf_dir, "part"), F.col("p_partkey")
    rule = F.concat(F.lit("R"), key.cast("string"))
    columns = [F.col("p_brand").alias("contract"), rule.alias("rule_id"), F.col("p_type").alias("dimension")]
    enforced = F.when(key % 3 == 0, "eval-fixture").otherwise("manual").alias("enforced_by")
    rules = part.select(*columns, enforced)
    differs = F.when(key % 11 == 0, "other").otherwise(F.col("p_type")).alias("dimension")
    assertions = part.where(key % 5 != 0).select(*columns[:2], differs)
    assertions = assertions.unionByName(part.where(key % 14 == 1).select(*columns))
    extra = F.concat(F.lit("X"), key.cast("string")).alias("rule_id")
    assertions = assertions.unionByName(part.where(key % 13 == 0).select(columns[0], extra, columns[2]))
    return Q.linkage(rules, assertions)


@query(
    "tagged_columns",
    """SELECT table_name, column_name, CASE WHEN column_name LIKE '%custkey' THEN 'customer_id' WHEN column_name = 'c_name' THEN 'customer_name'
  WHEN column_name = 'c_nationkey' THEN 'store_metadata' ELSE 'financial_amount' END AS tag_value, c.n AS tagged_rows
FROM information_schema.columns JOIN (SELECT 'customer' AS table_name, count(*) AS n FROM customer UNION ALL SELECT 'orders', count(*) FROM orders) c USING (table_name)
WHERE column_name IN ('c_custkey', 'c_name', 'c_nationkey', 'c_acctbal', 'o_custkey', 'o_totalprice')""",
)
def tagged_columns(spark, sf_dir):
    """Every tagged column of the two tables, and how many rows it covers."""
    named = {"customer": customers(spark, sf_dir).drop("email"), "orders": orders(spark, sf_dir)}
    audit = G.tag_audit(spark, named).select("table_name", "column_name", "tag_value")
    counts = Q.tables_inventory(named).withColumnRenamed("row_count", "tagged_rows")
    return audit.join(counts, "table_name")


@query(
    "denied_columns",
    """SELECT persona, denied, CASE WHEN denied IS NULL THEN (SELECT count(*) FROM orders) ELSE 0 END AS rows_read
FROM (VALUES ('lead', NULL), ('analyst', NULL), ('auditor', 'auditor may not read o_custkey'),
             ('guest', 'guest may not read o_custkey, o_totalprice')) AS t(persona, denied)""",
)
def denied_columns(spark, sf_dir):
    """Four personas ask for the whole orders table; who may not read a column is told which, and reads nothing."""
    o, out = orders(spark, sf_dir), None
    for persona in (LEAD, ANALYST, AUDITOR, "guest"):
        try:
            rows, denied = G.secured_view(o, persona, POLICIES).agg(F.count(F.lit(1)).alias("rows_read")), None
        except PermissionError as e:
            rows, denied = o.limit(0).agg(F.count(F.lit(1)).alias("rows_read")), str(e)
        told = rows.select(F.lit(persona).alias("persona"), F.lit(denied).cast("string").alias("denied"), "rows_read")
        out = told if out is None else out.unionByName(told)
    return out


@query(
    "guard_verdicts",
    """SELECT * FROM (VALUES ('one_day', TRUE, TRUE), ('all_days', FALSE, TRUE), ('other_column', FALSE, TRUE), ('small_limit', TRUE, FALSE))
AS t(request, filtered, within_limit) CROSS JOIN (SELECT count(*) AS rows_of_day FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-05')""",
)
def guard_verdicts(spark, sf_dir):
    """Which requests the plan guards let through, over events written by day; a request that passes reads its day."""
    path = _folder(spark, "guarded")
    sinks.write_dated(V.table(spark, sf_dir, "events").withColumn("business_date", F.to_date("ts")), path)
    events = spark.read.parquet(path)
    day = events.where(F.col("business_date") == F.lit("2024-01-05").cast("date"))
    asked = [("one_day", day, 1 << 40), ("all_days", events, 1 << 40), ("other_column", events.where("user_id = 3"), 1 << 40), ("small_limit", day, 10)]

    def passes(check, *args):
        try:
            check(*args)
        except (guards.PartitionFilterError, guards.ScanLimitError):
            return False
        return True

    rows = [(n, passes(guards.require_partition_filter, df, "business_date"), passes(guards.require_scan_within, df, limit)) for n, df, limit in asked]
    verdicts = spark.createDataFrame(rows, "request string, filtered boolean, within_limit boolean")
    return verdicts.withColumn("rows_of_day", F.lit(day.count()).cast("long"))


# Planted faults: both outcomes.


@query(
    "null_keys_dropped",
    """WITH keyed AS (SELECT *, event_id % 13 = 0 AS no_id, event_id % 17 = 0 AS no_store FROM events)
SELECT CAST(ts AS DATE) AS business_date, printf('STORE_%03d', user_id) AS store_id,
  CAST(round(sum(CAST(value AS DECIMAL(28, 9))), 2) AS DOUBLE) AS intraday_gross_revenue_usd
FROM keyed WHERE NOT no_id AND NOT no_store GROUP BY ALL""",
)
def null_keys_dropped(spark, sf_dir):
    """Store-day revenue of events of which some have no transaction id and some no store."""
    key = F.col("_msk_message_id").cast("long")
    bronze = V.bronze_events(spark, sf_dir).withColumns(
        {"transaction_id": F.when(key % 13 != 0, F.col("transaction_id")), "store_id": F.when(key % 17 != 0, F.col("store_id"))}
    )
    return L.silver_sales(bronze, SETTINGS).revenue


@query(
    "declared_dates",
    """SELECT CASE WHEN event_id % 3 = 0 THEN DATE '2024-02-01' + CAST(event_id % 5 AS INTEGER) ELSE CAST(ts AS DATE) END AS business_date,
  count(*) AS events, count(*) FILTER (event_id % 3 = 0) AS declared
FROM events WHERE NOT (event_id % 7 = 0 AND event_id % 3 <> 0) GROUP BY 1""",
)
def declared_dates(spark, sf_dir):
    """Events of which a third declare their business date, some in words that are no date, and some have no readable time."""
    from aislewise.functions.time import business_date, event_time

    key = F.col("event_id")
    rows = V.table(spark, sf_dir, "events").select(
        "event_id",
        F.when(key % 3 == 0, F.date_format(F.date_add(F.lit("2024-02-01").cast("date"), (key % 5).cast("int")), "yyyy-MM-dd"))
        .when(key % 3 == 1, "no date")
        .alias("business_date"),
        F.when(key % 7 == 0, "no time").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("event_timestamp"),
    )
    dated = rows.select("event_id", business_date(F.col("business_date"), event_time("event_timestamp")).alias("business_date"))
    return dated.where("business_date IS NOT NULL").groupBy("business_date").agg(
        F.count(F.lit(1)).alias("events"), F.count_if(F.col("event_id") % 3 == 0).alias("declared")
    )


@query(
    "extraction_gate_broken",
    f"""WITH {PAGES_SQL}, faulty AS (
  SELECT CASE WHEN page_id % 9 = 0 THEN 'N/A' ELSE title END AS title, CASE WHEN page_id % 6 = 0 THEN NULL ELSE heading END AS heading,
         CASE WHEN page_id % 4 = 0 THEN left(content, 20) ELSE content END AS content FROM assembled),
s AS (
  SELECT count(*) AS total_rows, count(*) FILTER (title IS NULL OR title = 'N/A') AS n_missing_title,
         count(*) FILTER (heading IS NULL OR heading = 'N/A') AS n_missing_heading,
         round(avg(length(content))) AS avg_content_chars, min(length(content)) AS min_content_chars,
         max(length(content)) AS max_content_chars FROM faulty)
SELECT *, total_rows > 0 AND n_missing_title = 0 AND n_missing_heading = 0 AND min_content_chars >= 60 AS passed FROM s""",
)
def extraction_gate_broken(spark, sf_dir):
    """The gate over pages whose titles, headings and contents were damaged: it must not pass."""
    key = F.col("page_id")
    pages = page_documents(spark, sf_dir).withColumns(
        {
            "title": F.when(key % 9 == 0, "N/A").otherwise(F.col("title")),
            "heading": F.when(key % 6 != 0, F.col("heading")),
            "content": F.when(key % 4 == 0, F.substring("content", 1, 20)).otherwise(F.col("content")),
        }
    )
    required = ["title", "heading"]
    return D.extraction_gate(D.extraction_summary(pages, "content", required), required, 60)


@query(
    "faults_named",
    r"""SELECT regexp_matches(line, 'ERR[-_](PAY|SYNC|NET|PRN|INV)[-_]\d{3,4}') AS names_fault, kind, count(*) AS documents FROM (
  SELECT doc_id % 5 AS kind, coalesce(text, '') || CASE doc_id % 5 WHEN 0 THEN ' ERR-PAY-101' WHEN 1 THEN ' ERR_NET_2024' WHEN 2 THEN ' ERR-PAY-12'
    WHEN 3 THEN ' ERR-CPU-101' ELSE '' END AS line FROM documents) GROUP BY ALL""",
)
def faults_named(spark, sf_dir):
    """Documents with an error code put at their end: two kinds of code that name a fault, two that do not."""
    from aislewise.functions.text import names_fault

    kind = F.col("doc_id") % 5
    code = F.when(kind == 0, " ERR-PAY-101").when(kind == 1, " ERR_NET_2024").when(kind == 2, " ERR-PAY-12").when(kind == 3, " ERR-CPU-101").otherwise("")
    docs = V.table(spark, sf_dir, "documents").select(kind.alias("kind"), F.concat(F.coalesce("text", F.lit("")), code).alias("line"))
    return docs.groupBy(names_fault(F.col("line")).alias("names_fault"), "kind").agg(F.count(F.lit(1)).alias("documents"))


BUSY_SQL = f"""{CHECKOUTS_SQL},
busy AS (SELECT * REPLACE ('STORE_001' AS store_id, 'CASH_' || (1000 + CAST(substr(transaction_id, 5) AS BIGINT) % 2) AS cashier_id) FROM checkouts),
ends AS (
  SELECT DISTINCT store_id, cashier_id, time_bucket(INTERVAL 10 SECOND, event_ts) + INTERVAL 10 SECOND AS window_end FROM busy
),
rolling AS (
  SELECT e.store_id, e.cashier_id, window_end, {METRICS_SQL}
  FROM ends e JOIN busy c ON c.store_id = e.store_id AND c.cashier_id = e.cashier_id
   AND c.event_ts >= e.window_end - INTERVAL 1 HOUR AND c.event_ts < e.window_end
  GROUP BY e.store_id, e.cashier_id, window_end
)"""


@query(
    "busy_cashiers",
    f"""WITH {BUSY_SQL} SELECT cashier_id, {RULE_SQL} AS heuristic_rule, CASE WHEN {RULE_SQL} THEN 'review' ELSE 'clear' END AS audit_status,
  count(*) AS hours, max(cashier_1h_txn_count) AS most_events, max(cashier_1h_manual_override_count) AS most_overrides
FROM rolling GROUP BY ALL""",
)
def busy_cashiers(spark, sf_dir):
    """All events at two registers, so that hours hold many of them and the override rule fires."""
    number = F.substring("transaction_id", 5, 18).cast("long")
    busy = V.checkouts(spark, sf_dir).withColumns(
        {"store_id": F.lit("STORE_001"), "cashier_id": F.concat(F.lit("CASH_"), (1000 + number % 2).cast("string"))}
    )
    scored = scoring.score_cashiers(windows.rolling_metrics(busy), scorer=None)
    return scored.groupBy("cashier_id", "heuristic_rule", "audit_status").agg(
        F.count(F.lit(1)).alias("hours"), F.max("cashier_1h_txn_count").alias("most_events"),
        F.max("cashier_1h_manual_override_count").alias("most_overrides"),
    )


@query(
    "extracted_by_model",
    """SELECT page_id, nullif(regexp_extract(html, '(?s)<title>(.*?)</title>', 1), '') AS title, CAST(length(html) AS BIGINT) AS size FROM pages""",
)
def extracted_by_model(spark, sf_dir):
    """Fields of every page from a plugged-in extractor that answers in JSON, as a model does."""
    import json
    import re

    def extractor(df):
        def run(batches):
            for pdf in batches:
                found = [re.search(r"<title>(.*?)</title>", h or "", re.S) for h in pdf["html"]]
                sizes = [None if h is None else len(h) for h in pdf["html"]]
                pdf["extracted"] = [json.dumps({"title": (m[1] or None) if m else None, "size": n}) for m, n in zip(found, sizes)]
                yield pdf[["page_id", "extracted"]]

        return df.select("page_id", "html").mapInPandas(run, "page_id long, extracted string")

    fields = [D.Field("title", "string", ""), D.Field("size", "bigint", "")]
    return D.extract_with(V.table(spark, sf_dir, "pages"), extractor, fields, ["page_id"])


@query(
    "silver_written",
    """WITH keyed AS (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) % 20 AS k FROM events)
SELECT CASE WHEN k IN (3, 4) THEN 'dead_letter' ELSE 'silver' END AS written_to,
  CASE WHEN k NOT IN (3, 4) THEN CAST(date_trunc('second', ts) - INTERVAL 4 HOUR AS DATE) END AS business_date, count(*) AS n_rows FROM keyed GROUP BY ALL""",
)
def silver_written(spark, sf_dir):
    """All events as JSON through the intake stream: the silver table by day, and the dead letters."""
    from aislewise.sources.streams import text_events
    from aislewise.streaming import jobs

    root, k = _folder(spark, "silver"), V.quantity()
    event = F.to_json(
        F.struct(
            F.when(k % 20 != 4, F.col("event_id").cast("string")).alias("transaction_id"),
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("event_timestamp"),
            V.store_of("user_id").alias("store_id"),
        )
    )
    text = F.when(k % 20 == 3, F.lit("{")).otherwise(event)
    V.table(spark, sf_dir, "events").select(text.alias("value")).write.text(f"{root}/in")
    lake = jobs.Lake(f"{root}/lake")
    jobs.ingest(text_events(spark, f"{root}/in"), lake).awaitTermination()
    n = F.count(F.lit(1)).alias("n_rows")
    silver = spark.read.parquet(lake.path("silver")).groupBy(F.lit("silver").alias("written_to"), "business_date").agg(n)
    dead = spark.read.parquet(lake.path("dead_letter")).agg(n)
    return silver.unionByName(dead.select(F.lit("dead_letter").alias("written_to"), F.lit(None).cast("date").alias("business_date"), "n_rows"))
