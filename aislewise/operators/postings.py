"""A positional inverted index over chunks: where each word stands, written once, and looked up by word.

Words come with their positions in a chunk, hyphenated codes without. Postings lie in folders by a hash of their token, so a
lookup opens the folders of its tokens only. A dictionary beside them holds for each token in how many chunks it stands and
the first of these. No lookup reads a text.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aislewise.functions.text import CODE_PATTERN, first_match
from aislewise.operators.documents import words
from aislewise.session import shared_dir, stored

FOLDERS = 64
WORD, CODE = "word", "code"


def folder_of(token: Column) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(FOLDERS)).cast("int")


@dataclass(frozen=True)
class Postings:
    """Where the index lies, and the name of the document column."""

    path: str
    document: str

    def entries(self, spark: SparkSession) -> DataFrame:
        """(kind, folder, token, document, chunk_index, positions)"""
        return spark.read.parquet(f"{self.path}/entries")

    def dictionary(self, spark: SparkSession) -> DataFrame:
        """(kind, folder, token, chunks, first): number of chunks that hold the token, and the first by document and index."""
        return spark.read.parquet(f"{self.path}/dictionary")


def build(chunk_table: DataFrame, document: str, path: str | None = None) -> Postings:
    """Writes the index of ``chunk_table`` (document, chunk_index, chunk_content), by default to the shared folder.

    A row is a token of a chunk, so no token, however common, is gathered into one row or task. A chunk's tokens are grouped
    inside its row: its words are sorted with their positions, and a token is a run of them. Only texts of one place are brought
    together for that, and chunks dealt out by their document lie together already.
    """
    spark = chunk_table.sparkSession
    index = Postings(path or f"{shared_dir(spark)}/postings-{uuid.uuid4().hex}", document)
    texts = chunk_table.groupBy(document, "chunk_index").agg(F.collect_list("chunk_content").alias("texts"))
    placed = F.transform("texts", lambda t: F.transform(words(t), lambda w, i: F.struct(w.alias("token"), i.alias("position"))))
    codes = F.transform("texts", lambda t: F.regexp_extract_all(t, F.lit(CODE_PATTERN), F.lit(0)))
    codes = F.array_distinct(F.transform(F.flatten(codes), lambda t: F.lower(t)))
    tokens = texts.select(document, "chunk_index", F.sort_array(F.flatten(placed)).alias("words"), codes.alias("codes"))

    def starts(w: Column) -> Column:
        return F.filter(F.sequence(F.lit(0), F.size(w) - 1), lambda i: (i == 0) | (F.get(w, i)["token"] != F.get(w, i - 1)["token"]))

    begins = F.when(F.size("words") > 0, starts(F.col("words"))).otherwise(F.array().cast("array<int>"))
    tokens = tokens.withColumn("begins", begins)

    def run(begin: Column, k: Column) -> Column:
        length = F.coalesce(F.get("begins", k + 1), F.size("words")) - begin
        return F.struct(F.get("words", begin)["token"].alias("token"), F.slice("words", begin + 1, length)["position"].alias("positions"))

    worded = tokens.select(F.lit(True).alias("is_word"), document, "chunk_index", F.inline(F.transform("begins", run)))
    coded = tokens.select(F.lit(False).alias("is_word"), document, "chunk_index", F.explode("codes").alias("token"))
    coded = coded.withColumn("positions", F.array().cast("array<int>"))
    # Rows that follow each other with the same token are moved in fewer bytes.
    entries = worded.sortWithinPartitions("token").unionByName(coded.sortWithinPartitions("token"))
    _write(entries, f"{index.path}/entries", "token", document, "chunk_index")
    first = F.min(F.struct(F.col(document).alias("doc"), F.col("chunk_index").alias("at"))).alias("first")
    dictionary = index.entries(spark).groupBy((F.col("kind") == WORD).alias("is_word"), "token").agg(F.count(F.lit(1)).alias("chunks"), first)
    _write(dictionary, f"{index.path}/dictionary", "token")
    return index


def _write(rows: DataFrame, path: str, *order: str) -> None:
    """Kind and folder travel as one small number; the names of the folders are made where the rows are written."""
    dealt = rows.withColumn("part", 2 * folder_of(F.col("token")) + F.col("is_word").cast("int")).drop("is_word")
    dealt = dealt.hint("rebalance", F.col("part")).sortWithinPartitions("part", *order)
    kind = F.when(F.col("part") % 2 == 1, WORD).otherwise(CODE)
    named = dealt.withColumns({"kind": kind, "folder": F.floor(F.col("part") / 2).cast("int")}).drop("part")
    named.write.partitionBy("kind", "folder").parquet(path)


def match_codes(asked: DataFrame, index: Postings) -> DataFrame:
    """(query_id, place) of questions given as (query_id, token): the first chunk that holds the code."""
    known = index.dictionary(asked.sparkSession).where(F.col("kind") == CODE)
    wanted = asked.withColumn("folder", folder_of(F.col("token")))
    return wanted.join(known, ["folder", "token"]).select("query_id", F.col("first").alias("place"))


def match_phrases(asked: DataFrame, index: Postings) -> DataFrame:
    """(query_id, document, chunk_index) of all chunks that hold the words of a question in a row; ``asked`` has (query_id, words).

    Candidates are the places of each question's rarest word; a word that no chunk holds is rarest of all, and its question
    has none. The other words are looked up in these chunks only, by equal joins, and their positions shifted back to where
    the phrase would begin: a chunk holds it where all its words agree on the beginning.
    """
    spark, document = asked.sparkSession, index.document
    entries = index.entries(spark).where(F.col("kind") == WORD).drop("kind")
    known = index.dictionary(spark).where(F.col("kind") == WORD).select("folder", "token", "chunks")
    asked = asked.where(F.size("words") > 0)
    placed = asked.select("query_id", F.size("words").alias("length"), F.posexplode("words").alias("offset", "token"))
    # Written first: so their size is known when the joins are planned, and postings need not be shuffled to meet few words.
    placed = stored(placed.withColumn("folder", folder_of(F.col("token"))), "asked")
    # No other token's postings take part in a join.
    entries = entries.join(placed.select("folder", "token").distinct(), ["folder", "token"], "left_semi")
    rated = placed.join(known, ["folder", "token"], "left")
    rarest = rated.groupBy("query_id").agg(F.min(F.struct(F.coalesce("chunks", F.lit(0)).alias("n"), "token", "folder")).alias("r"))
    rarest = rarest.select("query_id", "r.token", "r.folder")
    candidates = rarest.join(entries, ["folder", "token"]).select("query_id", document, "chunk_index")
    wanted = candidates.join(placed, "query_id")
    found = wanted.join(entries, ["folder", "token", document, "chunk_index"])
    begins = found.select("query_id", document, "chunk_index", "length", "offset", F.explode("positions").alias("position"))
    begins = begins.withColumn("begin", F.col("position") - F.col("offset"))
    whole = begins.groupBy("query_id", document, "chunk_index", "begin").agg(F.count(F.lit(1)).alias("n"), F.first("length").alias("length"))
    return whole.where("n = length").select("query_id", document, "chunk_index").distinct()


def match_text(queries: DataFrame, index: Postings) -> DataFrame:
    """For each question, the first chunk (by document and index) that holds its search token: the code that it names, or else
    its words in a row."""
    code = F.lower(first_match(F.col("query"), f"({CODE_PATTERN})"))
    asked = stored(queries.select("query_id", "query", code.alias("_code")), "asked")
    by_code = match_codes(asked.where(F.col("_code").isNotNull()).select("query_id", F.col("_code").alias("token")), index)
    phrases = asked.where(F.col("_code").isNull()).select("query_id", words(F.col("query")).alias("words"))
    place = F.min(F.struct(F.col(index.document).alias("doc"), F.col("chunk_index").alias("at"))).alias("place")
    by_phrase = match_phrases(phrases, index).groupBy("query_id").agg(place)
    return by_code.unionByName(by_phrase).select(
        "query_id", F.col("place.doc").alias(index.document), F.col("place.at").alias("chunk_index")
    )
