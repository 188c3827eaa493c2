"""Functions that SQL text can call: patterns over published views, and chunks of texts.

``publish`` makes table functions of the session; a query then names them in its FROM clause and joins their rows like any
table's.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Row, SparkSession
from pyspark.sql.functions import udtf

from aislewise.functions.text import WHITESPACE
from aislewise.operators.graph import PropertyGraph

CHUNK, STEP, SHORTEST = 500, 400, 30


class Chunks:
    """Overlapping chunks of the texts of a TABLE argument with columns ``id`` and ``text``; short ones leave gaps."""

    def eval(self, row: Row) -> Iterator[tuple]:
        text = row["text"]
        for k in range(max(1, -(-len(text or "") // STEP))):
            part = (text or "")[k * STEP : k * STEP + CHUNK]
            if len(part.strip(WHITESPACE)) > SHORTEST:
                yield row["id"], k, part


class BestRows:
    """The ``k`` rows with the largest score of each partition of a TABLE argument (columns ``key`` and ``score``), ties by key.
    Call with PARTITION BY; a partition is streamed, never held."""

    def __init__(self) -> None:
        self.best: list[tuple] = []
        self.k = 1

    def eval(self, row: Row, k: int) -> None:
        self.k = k
        self.best = sorted([*self.best, (-row["score"], row["key"], row["part"])], key=lambda r: r[:2])[:k]

    def terminate(self) -> Iterator[tuple]:
        for place, (score, key, part) in enumerate(self.best, 1):
            yield part, key, -score, place


def publish_graph(spark: SparkSession, graph: PropertyGraph, prefix: str = "graph") -> None:
    """Node and edge tables as views ``<prefix>_<label>``, and the pattern supplier, lot, customer as the table function
    ``lot_sales(least_risk)``; its filters reach the views' scans."""
    for label, part in [*graph.nodes.items(), *graph.edges.items()]:
        part.table.createOrReplaceTempView(f"{prefix}_{label.lower()}")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION lot_sales(least_risk DOUBLE)
        RETURNS TABLE(supplier_id BIGINT, facility_name STRING, risk_score DOUBLE, batch_id STRING, item_id BIGINT,
                      customer_id BIGINT, transaction_id BIGINT, exposure_flag STRING)
        RETURN SELECT s.supplier_id, s.facility_name, s.risk_score, b.batch_id, b.item_id, c.customer_id, p.transaction_id, p.exposure_flag
               FROM {prefix}_supplier s
               JOIN {prefix}_produced_batch m ON m.source_supplier_id = s.supplier_id
               JOIN {prefix}_batchlot b ON b.batch_id = m.target_batch_id
               JOIN {prefix}_purchased_lot_by_customer p ON p.{graph.edges["PURCHASED_LOT_BY_CUSTOMER"].source[0]} = b.batch_id
               JOIN {prefix}_customer c ON c.customer_id = p.{graph.edges["PURCHASED_LOT_BY_CUSTOMER"].target[0]}
               WHERE s.risk_score >= least_risk""")


def publish_text_functions(spark: SparkSession) -> None:
    """``text_chunks(TABLE(..))`` and ``best_rows(TABLE(..) PARTITION BY (part), k)``."""
    spark.udtf.register("text_chunks", udtf(Chunks, returnType="id bigint, chunk_index int, chunk_content string"))
    spark.udtf.register("best_rows", udtf(BestRows, returnType="part string, key bigint, score double, place int"))
