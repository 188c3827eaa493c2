"""Embedding, exact vector search, neighbour stitching, grounding gate and token fallback."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aislewise.functions.text import CODE_PATTERN, https_link
from aislewise.operators import postings
from aislewise.operators.dedup import top_per_key
from aislewise.operators.documents import words
from aislewise.session import cut_lineage, stored

# The gate, and the score a text match is given.
SIMILARITY_THRESHOLD = 0.70
TEXT_MATCH_SCORE = 0.85
VECTOR_MATCH, TEXT_MATCH, NO_MATCH = "VECTOR_MATCH", "TEXT_MATCH", "NO_CERTIFIED_MATCH"
DIMENSIONS = 256
# Ranks compare distances at nine digits, so equal texts tie whatever the order of additions.
RANK_DIGITS = 9
BROADCAST_BYTES = 64 << 20
# Cells of a product of queries and rows: a task holds several arrays of so many cells at once.
PRODUCT_CELLS = 1 << 20
# So many matches' documents are sent to every task; above that, the join deals out texts and matches alike.
FEW_MATCHES = 1 << 20


def token_buckets(text: Column) -> Column:
    """The bucket (0 to 255) of every word, hashed in the JVM."""
    return F.transform(words(text), lambda w: F.conv(F.substring(F.md5(w), 1, 2), 16, 10).cast("int"))


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def _unit_counts(buckets: pa.Array) -> pa.Array:
    lengths = pc.fill_null(pc.list_value_length(buckets), 0).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(buckets)), lengths)
    cell = row * DIMENSIONS + buckets.flatten().to_numpy(zero_copy_only=False)
    # Counted as doubles and squared without a copy: a batch's vectors are in memory once. Sums of whole numbers are exact.
    counts = np.bincount(cell, weights=np.ones(len(cell)), minlength=len(buckets) * DIMENSIONS)
    counts = counts.reshape(-1, DIMENSIONS).astype(float, copy=False)  # without a word they are integers
    length = np.sqrt(np.einsum("ij,ij->i", counts, counts))[:, None]
    unit = np.divide(counts, length, out=counts, where=length > 0)
    offsets = pa.array(np.arange(len(buckets) + 1, dtype=np.int32) * DIMENSIONS)
    return pa.ListArray.from_arrays(offsets, pa.array(unit.ravel()), mask=buckets.is_null())


def hashed_embedding(text: Column) -> Column:
    """Deterministic default: word counts over 256 hashed buckets, length one."""
    return _unit_counts(token_buckets(text))


def embed(df: DataFrame, text: Column, embedder: Callable[[Column], Column] = hashed_embedding) -> DataFrame:
    """Add ``embedding``. A model takes the default's place as any column function (``pandas_udf``)."""
    return df.withColumn("embedding", embedder(text))


def chunk_text(title: Column) -> Column:
    """What is embedded for a chunk: its document's title in brackets, then its content."""
    return F.concat(F.lit("["), title, F.lit("]\n"), F.col("chunk_content"))


def new_embeddings(source: DataFrame, embedded: DataFrame, key: str, text: Column, embedder=hashed_embedding) -> DataFrame:
    """Rows the embedded table lacks, with ``embedding`` as a struct of result and status."""
    missing = source.join(embedded.select(key), key, "left_anti")
    return missing.withColumn("_v", embedder(text)).withColumn(
        "embedding",
        F.struct(F.col("_v").alias("result"), F.when(F.col("_v").isNull(), "no text").otherwise("").alias("status")),
    ).drop("_v")


def _unit_rows(matrix: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, length, out=np.full_like(matrix, np.nan), where=length > 0)


def _scorer(ids: pa.Array, matrix: np.ndarray, keys: Sequence[str], vector: str, top_k: int):
    """Per task: each query's best rows so far, given out once at the end of its partition.

    Batches are cut so that one product stays within a few million cells. Only rows at least as near as a query's
    current last are kept, then sorted by distance and key as the ranking does, so a task gives out at most
    ``top_k`` rows a query and ties fall the same way everywhere.
    """
    names = ["q", *keys, "distance"]
    order = [("q", "ascending"), ("distance", "ascending"), *((k, "ascending") for k in keys)]

    def near(batch: pa.RecordBatch, floor: np.ndarray) -> pa.Table:
        lengths = pc.list_value_length(batch.column(vector)).to_numpy(zero_copy_only=False)
        if (lengths != matrix.shape[1]).any():
            wrong = int((lengths != matrix.shape[1]).sum())
            raise ValueError(f"{wrong} of {batch.num_rows} corpus vectors are not {matrix.shape[1]} wide like the queries")
        values = batch.column(vector).flatten().to_numpy(zero_copy_only=False).astype(float, copy=False)
        distance = matrix @ _unit_rows(values.reshape(batch.num_rows, -1)).T
        np.round(np.subtract(1.0, distance, out=distance), RANK_DIGITS, out=distance)
        distance[~np.isfinite(distance)] = np.inf
        k = min(top_k, batch.num_rows)
        last = np.minimum(np.partition(distance, k - 1, axis=1)[:, k - 1], floor) if k == top_k else floor
        q, r = np.nonzero((distance <= last[:, None]) & (distance < np.inf))
        rows = pa.array(r)
        return pa.table([pa.array(q), *[batch.column(c).take(rows) for c in keys], pa.array(distance[q, r])], names=names)

    def best(rows: pa.Table) -> tuple[pa.Table, np.ndarray]:
        rows = rows.take(pc.sort_indices(rows, sort_keys=order, null_placement="at_start"))
        q = rows.column("q").to_numpy()
        place = np.arange(len(q)) - np.searchsorted(q, q)
        rows = rows.filter(pa.array(place < top_k))
        q, place = q[place < top_k], place[place < top_k]
        floor = np.full(len(matrix), np.inf)
        full = place == top_k - 1
        floor[q[full]] = rows.column("distance").to_numpy()[full]
        return rows, floor

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, floor = None, np.full(len(matrix), np.inf)
        for batch in batches:
            step = max(1, PRODUCT_CELLS // max(1, len(ids)))
            for start in range(0, batch.num_rows if len(ids) else 0, step):
                found = near(batch.slice(start, step), floor)
                if found.num_rows:
                    held, floor = best(pa.concat_tables([held, found]) if held is not None else found)
        for part in held.to_batches(max_chunksize=10_000) if held is not None else ():
            yield pa.RecordBatch.from_arrays(
                [ids.take(part.column("q")), *[part.column(k) for k in keys], part.column("distance")],
                names=["query_id", *keys, "distance"],
            )

    return run


def vector_search(
    corpus: DataFrame,
    queries: DataFrame,
    keys: Sequence[str],
    top_k: int = 3,
    vector: str = "embedding",
    query_id: str = "query_id",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The ``top_k`` rows of the corpus nearest to each query by cosine distance, exactly.

    The corpus is scanned where it lies; a task shuffles at most ``top_k`` rows a query. Query vectors go to every
    task, never more than ``broadcast_bytes`` of them at once on average: the query set is cut into blocks by a hash
    of its rows. Each block is one corpus scan whose ranking is checkpointed before the next block is sent, with any
    number of blocks, so neither the driver nor a task holds more than one. Query ids are unique.

    All vectors have one width: queries or corpus rows of another raise an error with their number. Queries and rows
    without a vector, or with one of length zero, have no distance and take no part; ``retrieve`` reports them.
    """
    spark = corpus.sparkSession
    asked = queries.filter(F.col(vector).isNotNull()).select(F.col(query_id).alias("query_id"), F.col(vector).alias("v"))
    n, narrow, width = asked.agg(F.count(F.lit(1)), F.min(F.size("v")), F.max(F.size("v"))).first()
    if narrow != width:
        raise ValueError(f"{n} query vectors are between {narrow} and {width} wide")
    blocks = max(1, math.ceil(2 * n * (width or 0) * 8 / broadcast_bytes))
    pool = corpus.filter(F.col(vector).isNotNull()).select(*keys, vector)
    schema = T.StructType(
        [asked.schema["query_id"], *[corpus.schema[k] for k in keys], T.StructField("distance", T.DoubleType())]
    )

    found = []
    for b in range(blocks):
        rows = asked.filter(F.pmod(F.xxhash64("query_id", "v"), F.lit(blocks)) == b).toArrow()
        matrix = _unit_rows(np.array(rows.column("v").to_pylist(), dtype=float).reshape(rows.num_rows, width or 0))
        sent = spark.sparkContext.broadcast((rows.column("query_id").combine_chunks(), matrix))

        def search(batches, sent=sent):
            return _scorer(*sent.value, keys, vector, top_k)(batches)

        best = top_per_key(pool.mapInArrow(search, schema), ["query_id"], ["distance", *keys], top_k)
        found.append(cut_lineage(best.withColumn("similarity_score", F.round(1.0 - F.col("distance"), 4))))
        sent.unpersist()
    return reduce(DataFrame.unionByName, found)


def semantic_search(
    queries: DataFrame,
    corpus: DataFrame,
    keys: Sequence[str],
    top_k: int = 3,
    embedder: Callable[[Column], Column] = hashed_embedding,
) -> DataFrame:
    """Text in, nearest rows out: ``queries`` has ``query_id`` and ``query``, the corpus its ``embedding``."""
    return vector_search(corpus, embed(queries.select("query_id", "query"), F.col("query"), embedder), keys, top_k)


def of_matches(table: DataFrame, matches: DataFrame, document: str) -> DataFrame:
    """The rows of documents that have a match, found without moving any. Where matches are too many to be sent to every task,
    all rows: the join that follows is to deal them out then."""
    if matches.count() > FEW_MATCHES:
        return table
    found = matches.select(F.col(document).alias("_of")).distinct()
    return table.join(F.broadcast(found), F.col(document) == F.col("_of"), "left_semi")


def stitch(
    matches: DataFrame,
    chunk_table: DataFrame,
    document: str,
    keys: Sequence[str],
    radius: int = 1,
    separator: str = "\n",
    trim_overlap: int = 0,
) -> DataFrame:
    """Matched chunks with their neighbours' text, in order.

    The wanted indexes are listed first, so the neighbours come from an equi join, not a range join. Where matches are few, only
    their documents' texts take part in it.
    ``keys`` identify a match. Overlapping text is kept as the chunks hold it, unless ``trim_overlap`` says
    how many characters a chunk shares with the one before it.
    """
    matches = stored(matches, "matches")
    chunk_table = of_matches(chunk_table, matches, document)
    wanted = matches.withColumn(
        "_wanted", F.explode(F.sequence(F.col("chunk_index") - radius, F.col("chunk_index") + radius))
    )
    near = chunk_table.select(
        F.col(document).alias("_doc"), F.col("chunk_index").alias("_wanted"), F.col("chunk_content").alias("_text")
    )
    joined = wanted.join(near, (F.col(document) == F.col("_doc")) & (wanted["_wanted"] == near["_wanted"])).select(
        *matches.columns, near["_wanted"].alias("_at"), "_text"
    )
    carried = [c for c in matches.columns if c not in keys]
    grouped = joined.groupBy(*keys).agg(
        *[F.first(c).alias(c) for c in carried],
        F.sort_array(F.collect_list(F.struct("_at", "_text"))).alias("_pieces"),
    )
    pieces = F.col("_pieces")

    def own_text(p, i):
        follows = F.get(pieces, i - 1)["_at"] == p["_at"] - 1
        return F.when(follows, F.substring(p["_text"], F.lit(trim_overlap + 1), F.length(p["_text"]))).otherwise(p["_text"])

    texts = F.transform(pieces, own_text if trim_overlap else (lambda p: p["_text"]))
    return grouped.withColumn("stitched_content", F.array_join(texts, separator)).drop("_pieces")


def text_matches(queries: DataFrame, chunk_table: DataFrame, document: str, index: postings.Postings | None = None) -> DataFrame:
    """For each question, the first chunk (by document and index) that holds its search token.

    A question that names a code looks for that code; any other looks for its words in order. The chunks' positional
    ``index`` answers both; without one it is built first.
    """
    return postings.match_text(queries, index or postings.build(chunk_table, document))


def retrieve(
    queries: DataFrame,
    chunk_table: DataFrame,
    document: str,
    embedder: Callable[[Column], Column] = hashed_embedding,
    threshold: float = SIMILARITY_THRESHOLD,
    index: postings.Postings | None = None,
) -> DataFrame:
    """Runbook text for every question: nearest chunk if it is close enough, else a text match, else none.

    ``queries`` has ``query_id`` and ``query``; ``chunk_table`` has the document key, ``chunk_index``,
    ``chunk_content`` and ``embedding``; ``index`` are its postings, built here if not given. All questions are answered
    together.
    """
    best = semantic_search(queries, chunk_table, [document, "chunk_index"], 1, embedder)
    grounded = best.filter(F.col("similarity_score") >= threshold).select(
        "query_id", document, "chunk_index", "similarity_score", F.lit(VECTOR_MATCH).alias("status")
    )
    open_questions = queries.select("query_id", "query").join(grounded.select("query_id"), "query_id", "left_anti")
    matched = text_matches(open_questions, chunk_table, document, index).select(
        "*", F.lit(TEXT_MATCH_SCORE).alias("similarity_score"), F.lit(TEXT_MATCH).alias("status")
    )
    answers = stitch(grounded.unionByName(matched), chunk_table, document, ["query_id"])
    return (
        queries.select("query_id")
        .join(answers, "query_id", "left")
        .withColumn("status", F.coalesce("status", F.lit(NO_MATCH)))
    )


def envelope(answers: DataFrame, catalog: DataFrame, document: str, host: str) -> DataFrame:
    """Answers with what a reader is shown besides the text: the document's title, its equipment and a clickable link.

    ``catalog`` has the document key, ``title``, ``equipment`` and ``uri``; a row a document. An answer without a match has
    none of them.
    """
    shown = catalog.select(document, "title", "equipment", https_link(F.col("uri"), host).alias("link"))
    return answers.join(shown, document, "left")
