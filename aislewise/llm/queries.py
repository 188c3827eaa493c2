"""One registered query per operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

import aislewise
from aislewise.llm import bpe, chat, embeddings, fmindex, minhash, nbsvm, packing, runs, secrets, toxicity, trie, urls, warc
from aislewise.llm.common import small_batches

# Workers of a session that was started elsewhere can't import this package, so its functions travel by value.
cloudpickle.register_pickle_by_value(aislewise)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# A conversation whose texts are control strings of the format, as its contract gives it.
HARD_TEXT = "\\### Assistant: </turn> ok"


@query
def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, formatted and read back, and the one that quotes control strings."""
    hard = spark.sql(
        "SELECT * FROM VALUES (-7L, 0L, 'user', :text), (-7L, 1L, 'assistant', :text) AS v(conv_id, turn, role, text)",
        args={"text": HARD_TEXT},
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(rows.unionByName(hard))


SQL["op1_chat"] = r"""
WITH plain AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), escaped AS (
    SELECT *,
        length(replace(replace(replace(text, '\', '\0'), '</turn>', '\1'), '###', '\2')) AS text_length,
        length(replace(replace(replace(replace(role, '\', '\0'), '</turn>', '\1'), '###', '\2'), ':', '\3')) AS role_length
    FROM plain
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
        AS loss_sha256,
    CAST(sum(4 + role_length + 2 + text_length + 8) AS BIGINT) AS formatted_chars
FROM escaped GROUP BY conv_id
"""

@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity categories of every document, learned from the labelled ones."""
    small_batches(spark)
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op3_fmindex(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark phrases in every document."""
    return fmindex.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document; a source owns the documents it publishes, and each of them is a repository."""
    return secrets.report(table(spark, sf_dir, "documents"))


URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


@query
def op5_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule and verdict for the URL of every page."""
    return urls.judge(table(spark, sf_dir, "pages"), urls.rule_table(spark, URL_RULES))


SQL["op5_urls"] = """
WITH split AS (
    SELECT page_id,
        translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages
), rules(rule_host, rule_path, verdict) AS (
    VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
        ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), judged AS (
    SELECT s.*, (
        SELECT max(struct_pack(n := length(rule_host || rule_path), rule := rule_host || rule_path, verdict := verdict))
        FROM rules
        WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    ) AS won FROM split s
)
SELECT page_id, host, path, won.rule AS rule, coalesce(won.verdict, 'allow') AS verdict FROM judged
"""


@query
def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate group of every document."""
    small_batches(spark)
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, written to WARC archives and read back from them."""
    return warc.round_trip(table(spark, sf_dir, "pages"))


@query
def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, encoded and decoded again."""
    small_batches(spark)
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate group of every embedding."""
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op10_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document, learned from the labelled ones."""
    small_batches(spark)
    return nbsvm.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens, packed into sequences of 2048."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every prefix of the conversations, with what its subtree holds."""
    return trie.report(table(spark, sf_dir, "conversations"))


CRC32 = """xor(list_reduce([4294967295::BIGINT] || list_transform(string_split({0}, ''), lambda x: ascii(x)::BIGINT),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT)"""

SQL["op12_trie"] = f"""
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
    FROM conversations WHERE conv_id IS NOT NULL
), members AS (
    SELECT conv_id, conv_id - conv_id % 20 AS base, {CRC32.format("CAST(conv_id AS VARCHAR)")} % 4 AS taken
    FROM (SELECT DISTINCT conv_id FROM turns)
), rebuilt AS (
    SELECT m.conv_id, role, text, place FROM members m JOIN turns t ON t.conv_id = m.base AND place <= taken
    UNION ALL SELECT m.conv_id, role, text, place FROM members m JOIN turns t ON t.conv_id = m.conv_id AND place > taken
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY place) AS depth FROM rebuilt
), walked AS (
    SELECT conv_id, depth, text, sha256(string_agg(sha256(role || chr(10) || text), ',') OVER (PARTITION BY conv_id ORDER BY depth)) AS node
    FROM placed
    UNION ALL SELECT conv_id, 0, '', '' FROM members
), nodes AS (
    SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
        (count(*) - 1) * len(regexp_extract_all(min(text), '[^\x20\x09-\x0D]+')) AS saved
    FROM walked GROUP BY node, depth
), linked AS (
    SELECT n.*, p.node AS parent, p.conv_id AS parent_conv_id
    FROM nodes n LEFT JOIN walked w ON w.conv_id = n.conv_id AND w.depth = n.depth - 1
    LEFT JOIN nodes p ON p.node = w.node AND p.depth = w.depth
), children AS (
    SELECT parent AS node, count(*) AS n_children FROM linked WHERE depth > 0 GROUP BY parent
), below AS (
    SELECT w.node, sum(n.saved) AS saved_tokens, count(*) FILTER (c.node IS NULL) AS n_leaves
    FROM nodes n LEFT JOIN children c ON c.node = n.node JOIN walked w ON w.conv_id = n.conv_id AND w.depth <= n.depth
    GROUP BY w.node
), ends AS (
    SELECT w.node, string_agg(CAST(w.conv_id AS VARCHAR), ',' ORDER BY w.conv_id) AS ids
    FROM walked w JOIN (SELECT conv_id, max(depth) AS depth FROM walked GROUP BY conv_id) USING (conv_id, depth) GROUP BY w.node
)
SELECT l.conv_id, l.depth, l.parent_conv_id, l.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
    CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM linked l JOIN below USING (node) LEFT JOIN children USING (node) LEFT JOIN ends USING (node)
"""


@query
def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document, some of which the contract rewrites."""
    return runs.report(table(spark, sf_dir, "documents"))
