"""Chunks, extraction, classification and retrieval over the whole documents, pages and embeddings."""

import uuid

from pyspark.sql import functions as F

from aislewise.functions import numbers
from aislewise.functions.text import WHITESPACE, https_link
from aislewise.operators import documents as D
from aislewise.operators import postings
from aislewise.operators import search as S
from aislewise.session import cut_lineage, stored
from workload import views as V
from workload.registry import query

SPACES_SQL = " || ".join(f"chr({ord(c)})" for c in WHITESPACE)
WORDS_SQL = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}]+')"

CHUNKS_SQL = f"""
pieces AS (
  SELECT doc_id, source, unnest(range(1, greatest(length(text), 1) + 1, 400)) AS pos, text FROM documents
),
chunks AS (
  SELECT doc_id, source, (pos - 1) // 400 AS chunk_index, substr(text, pos, 500) AS chunk_content
  FROM pieces WHERE length(trim(substr(text, pos, 500), {SPACES_SQL})) > 30
)"""

# Bucket counts of chunks and questions; the dot product of counts is exact in integers.
VECTORS_SQL = f"""{CHUNKS_SQL},
chunk_words AS (SELECT doc_id, chunk_index, unnest({WORDS_SQL.format("'[' || source || ']' || chr(10) || chunk_content")}) AS w FROM chunks),
chunk_counts AS (
  SELECT doc_id, chunk_index, CAST('0x' || substr(md5(w), 1, 2) AS INTEGER) AS bucket, count(*) AS n FROM chunk_words GROUP BY ALL
),
chunk_norms AS (SELECT doc_id, chunk_index, sqrt(CAST(sum(n * n) AS DOUBLE)) AS len FROM chunk_counts GROUP BY ALL),
query_words AS (SELECT item_id AS query_id, unnest({WORDS_SQL.format('text')}) AS w FROM benchmark),
query_counts AS (
  SELECT query_id, CAST('0x' || substr(md5(w), 1, 2) AS INTEGER) AS bucket, count(*) AS n FROM query_words GROUP BY ALL
),
query_norms AS (SELECT query_id, sqrt(CAST(sum(n * n) AS DOUBLE)) AS len FROM query_counts GROUP BY ALL),
dots AS (
  SELECT query_id, doc_id, chunk_index, sum(c.n * q.n) AS dot
  FROM chunk_counts c JOIN query_counts q USING (bucket) GROUP BY ALL
),
ranked AS (
  SELECT query_id, doc_id, chunk_index, round(1e0 - CAST(dot AS DOUBLE) / (c.len * q.len), 9) AS distance,
         row_number() OVER (PARTITION BY query_id
           ORDER BY round(1e0 - CAST(dot AS DOUBLE) / (c.len * q.len), 9), doc_id, chunk_index) AS rank
  FROM dots JOIN chunk_norms c USING (doc_id, chunk_index) JOIN query_norms q USING (query_id)
),
top3 AS (
  SELECT query_id, doc_id, chunk_index, CAST(rank AS INTEGER) AS rank, round(distance, 6) AS distance,
         round(1e0 - distance, 4) AS similarity_score
  FROM ranked WHERE rank <= 3
)"""


def chunk_table(spark, sf_dir, matches=None):
    """All chunks, or those of documents that have a match, where these are few: the others' texts are not dealt out for them."""
    only = None if matches is None else lambda documents: S.of_matches(documents, matches, "doc_id")
    return D.chunks(V.texts(spark, sf_dir, "documents", "doc_id", only), "text", ["doc_id", "source"])


def embedded_chunks(spark, sf_dir):
    return S.embed(chunk_table(spark, sf_dir), S.chunk_text(F.col("source")))


def questions(spark, sf_dir):
    return V.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))


@query("chunk_documents", f"WITH {CHUNKS_SQL} SELECT * FROM chunks")
def chunk_documents(spark, sf_dir):
    return chunk_table(spark, sf_dir)


@query(
    "embed_text",
    f"""WITH {VECTORS_SQL} SELECT doc_id, chunk_index, CAST(count(*) AS INTEGER) AS buckets_used,
round(max(n) / any_value(len), 9) AS largest FROM chunk_counts JOIN chunk_norms USING (doc_id, chunk_index) GROUP BY ALL""",
)
def embed_text(spark, sf_dir):
    """Every chunk's embedding, reported by its non-zero buckets and largest component."""
    used = F.size(F.filter("embedding", lambda x: x > 0))
    return embedded_chunks(spark, sf_dir).filter(F.array_max("embedding") > 0).select(
        "doc_id", "chunk_index", used.alias("buckets_used"), F.round(F.array_max("embedding"), 9).alias("largest")
    )


@query(
    "vector_topk",
    """WITH parts AS (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
centre AS (SELECT label, i, avg(CAST(x AS DOUBLE)) AS c FROM parts GROUP BY ALL),
dots AS (
  SELECT c.label AS query_id, p.vec_id, sum(c.c * p.x) / (sqrt(sum(c.c * c.c)) * sqrt(sum(CAST(p.x AS DOUBLE) * p.x))) AS s
  FROM parts p JOIN centre c USING (i) GROUP BY c.label, p.vec_id
)
SELECT query_id, vec_id, row_number() OVER (PARTITION BY query_id ORDER BY round(1 - s, 9), vec_id) AS rank,
       round(1 - s, 6) AS distance, round(s, 4) AS similarity_score
FROM dots QUALIFY rank <= 5""",
)
def vector_topk(spark, sf_dir):
    """The five vectors nearest to the centre of each label."""
    vectors = V.table(spark, sf_dir, "embeddings")
    parts = vectors.select("label", F.posexplode("embedding").alias("i", "x"))
    centre = parts.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("c"))
    queries = centre.groupBy(F.col("label").alias("query_id")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("i", "c"))), lambda p: p["c"]).alias("embedding")
    )
    hits = S.vector_search(vectors, queries, ["vec_id"], top_k=5)
    return hits.withColumn("distance", F.round("distance", 6))


@query("vector_topk_text", f"WITH {VECTORS_SQL} SELECT * FROM top3")
def vector_topk_text(spark, sf_dir):
    hits = S.semantic_search(questions(spark, sf_dir), embedded_chunks(spark, sf_dir), ["doc_id", "chunk_index"], 3)
    return hits.withColumn("distance", F.round("distance", 6))


@query(
    "stitch_neighbours",
    f"""WITH {VECTORS_SQL} SELECT query_id, t.doc_id, t.chunk_index, any_value(similarity_score) AS similarity_score,
string_agg(c.chunk_content, chr(10) ORDER BY c.chunk_index) AS stitched_content
FROM top3 t JOIN chunks c ON c.doc_id = t.doc_id AND c.chunk_index BETWEEN t.chunk_index - 1 AND t.chunk_index + 1
GROUP BY query_id, t.doc_id, t.chunk_index""",
)
def stitch_neighbours(spark, sf_dir):
    hits = S.semantic_search(questions(spark, sf_dir), embedded_chunks(spark, sf_dir), ["doc_id", "chunk_index"], 3)
    hits = hits.select("query_id", "doc_id", "chunk_index", "similarity_score")
    return S.stitch(hits, chunk_table(spark, sf_dir), "doc_id", ["query_id", "doc_id", "chunk_index"])


CODES_SQL = f"""{CHUNKS_SQL},
chunk_codes AS (
  SELECT DISTINCT doc_id, chunk_index, lower(unnest(regexp_extract_all(chunk_content, '[A-Za-z0-9]+-[A-Za-z0-9-]+'))) AS code FROM chunks
)"""


@query(
    "token_fallback",
    f"""WITH {CODES_SQL},
asked AS (
  SELECT DISTINCT 'How do I clear ' || code || '?' AS query, code
  FROM (SELECT unnest(regexp_extract_all(text, '[A-Za-z0-9]+-[A-Za-z0-9-]+')) AS code FROM documents)
),
place AS (
  SELECT query, min((doc_id, chunk_index)) AS p FROM asked JOIN chunk_codes k ON k.code = lower(asked.code) GROUP BY query
)
SELECT query AS query_id, p[1] AS doc_id, p[2] AS chunk_index,
       string_agg(c.chunk_content, chr(10) ORDER BY c.chunk_index) AS stitched_content
FROM place JOIN chunks c ON c.doc_id = p[1] AND c.chunk_index BETWEEN p[2] - 1 AND p[2] + 1 GROUP BY ALL""",
)
def token_fallback(spark, sf_dir):
    """Look up every code that occurs in the documents, as a question about it."""
    codes = F.explode(F.regexp_extract_all("text", F.lit(S.CODE_PATTERN), F.lit(0)))
    asked = V.table(spark, sf_dir, "documents").select(codes.alias("code")).distinct()
    ask = F.concat(F.lit("How do I clear "), "code", F.lit("?"))
    queries = asked.select(ask.alias("query_id"), ask.alias("query"))
    matches = stored(S.text_matches(queries, chunk_table(spark, sf_dir), "doc_id"), "matches")
    return S.stitch(matches, chunk_table(spark, sf_dir, matches), "doc_id", ["query_id", "doc_id", "chunk_index"])


@query(
    "grounding_gate",
    f"""WITH {VECTORS_SQL}, best AS (SELECT * FROM top3 WHERE rank = 1)
SELECT query_id, similarity_score, similarity_score >= 0.7 AS grounded FROM best""",
)
def grounding_gate(spark, sf_dir):
    best = S.semantic_search(questions(spark, sf_dir), embedded_chunks(spark, sf_dir), ["doc_id", "chunk_index"], 1)
    return best.select(
        "query_id", "similarity_score", (F.col("similarity_score") >= S.SIMILARITY_THRESHOLD).alias("grounded")
    )


RETRIEVED_SQL = f"""WITH {VECTORS_SQL},
grounded AS (SELECT query_id, doc_id, chunk_index, similarity_score, 'VECTOR_MATCH' AS status FROM top3
             WHERE rank = 1 AND similarity_score >= 0.70),
lines AS (SELECT doc_id, chunk_index, ' ' || array_to_string({WORDS_SQL.format('chunk_content')}, ' ') || ' ' AS line FROM chunks),
open_q AS (SELECT item_id AS query_id, ' ' || array_to_string({WORDS_SQL.format('text')}, ' ') || ' ' AS phrase
           FROM benchmark WHERE item_id NOT IN (SELECT query_id FROM grounded)),
places AS (SELECT query_id, min((doc_id, chunk_index)) AS p FROM open_q JOIN lines ON contains(line, phrase) GROUP BY 1),
matched AS (SELECT * FROM grounded UNION ALL SELECT query_id, p[1], p[2], 0.85e0, 'TEXT_MATCH' FROM places),
stitched AS (
  SELECT query_id, m.doc_id, m.chunk_index, similarity_score, status,
         string_agg(c.chunk_content, chr(10) ORDER BY c.chunk_index) AS stitched_content
  FROM matched m JOIN chunks c ON c.doc_id = m.doc_id AND c.chunk_index BETWEEN m.chunk_index - 1 AND m.chunk_index + 1
  GROUP BY ALL
),
answers AS (SELECT item_id AS query_id, doc_id, chunk_index, similarity_score, coalesce(status, 'NO_CERTIFIED_MATCH') AS status,
       stitched_content
FROM benchmark LEFT JOIN stitched ON query_id = item_id)"""


@query("retrieve_runbooks", f"{RETRIEVED_SQL} SELECT * FROM answers")
def retrieve_runbooks(spark, sf_dir):
    """The whole path at the operator's own gate: nearest chunk, else text match, else none."""
    return S.retrieve(questions(spark, sf_dir), embedded_chunks(spark, sf_dir), "doc_id")


@query(
    "retrieve_envelope",
    f"""{RETRIEVED_SQL} SELECT query_id, a.doc_id, status, d.source || ' ' || a.doc_id AS title, d.lang AS equipment,
  'https://manuals.example/' || d.source || '/' || a.doc_id || '.pdf' AS link
FROM answers a LEFT JOIN documents d USING (doc_id)""",
)
def retrieve_envelope(spark, sf_dir):
    """Every answer with the title, equipment and link of its document."""
    d = V.table(spark, sf_dir, "documents")
    number = F.col("doc_id").cast("string")
    catalog = d.select(
        "doc_id", F.concat("source", F.lit(" "), number).alias("title"), F.col("lang").alias("equipment"),
        F.concat(F.lit("gs://"), "source", F.lit("/"), number, F.lit(".pdf")).alias("uri"),
    )
    answers = S.envelope(retrieve_runbooks(spark, sf_dir), catalog, "doc_id", "https://manuals.example")
    return answers.select("query_id", "doc_id", "status", "title", "equipment", "link")


PHRASE_WORDS = 4


@query(
    "phrase_places",
    f"""WITH {CHUNKS_SQL},
lines AS (SELECT doc_id, chunk_index, ' ' || array_to_string({WORDS_SQL.format('chunk_content')}, ' ') || ' ' AS line FROM chunks),
asked AS (
  SELECT item_id AS query_id, {WORDS_SQL.format('text')} AS words FROM benchmark
),
phrases AS (
  SELECT query_id, ' ' || array_to_string(words[1:{PHRASE_WORDS}], ' ') || ' ' AS phrase FROM asked WHERE len(words) > 0
)
SELECT query_id, doc_id, chunk_index FROM phrases JOIN lines ON contains(line, phrase)""",
)
def phrase_places(spark, sf_dir):
    """Every chunk that holds the first words of a benchmark item in a row, from the positional index."""
    index = postings.build(chunk_table(spark, sf_dir), "doc_id")
    asked = questions(spark, sf_dir).select("query_id", F.slice(D.words(F.col("query")), 1, PHRASE_WORDS).alias("words"))
    return postings.match_phrases(asked, index)


PAGE_FIELDS = (
    D.Field("title", "string", r"(?s)<title>(.*?)</title>"),
    D.Field("heading", "string", r"(?s)<h1>(.*?)</h1>"),
    D.Field("page_lang", "string", r'<html lang="([a-z]+)"'),
    D.Field("ad_number", "bigint", r"<!-- ad ([0-9]+) -->"),
    D.Field("footer_host", "string", r"(?s)<footer>&copy; (\S+) "),
)
PAGES_SQL = r"""
fields AS (
  SELECT page_id, url, nullif(regexp_extract(html, '(?s)<title>(.*?)</title>', 1), '') AS title,
         nullif(regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1), '') AS heading,
         nullif(regexp_extract(html, '<html lang="([a-z]+)"', 1), '') AS page_lang,
         TRY_CAST(nullif(regexp_extract(html, '<!-- ad ([0-9]+) -->', 1), '') AS BIGINT) AS ad_number,
         nullif(regexp_extract(html, '(?s)<footer>&copy; (\S+) ', 1), '') AS footer_host
  FROM pages
),
assembled AS (
  SELECT *, 'SOURCE: ' || coalesce(url, '') || chr(10) || 'TITLE: ' || coalesce(title, '') || chr(10) || '### HEADING'
         || chr(10) || coalesce(heading, '') || chr(10) || '### HOST' || chr(10) || coalesce(footer_host, '') AS content
  FROM fields
)"""


def page_fields(spark, sf_dir):
    return D.extract_fields(V.table(spark, sf_dir, "pages"), "html", PAGE_FIELDS, ["page_id", "url"])


def page_documents(spark, sf_dir):
    parts = [("SOURCE: ", "url"), ("\nTITLE: ", "title"), ("\n### HEADING\n", "heading"), ("\n### HOST\n", "footer_host")]
    return page_fields(spark, sf_dir).withColumn("content", D.assemble(parts))


@query("extract_fields", f"WITH {PAGES_SQL} SELECT * FROM fields")
def extract_fields(spark, sf_dir):
    return page_fields(spark, sf_dir)


@query("assemble_documents", f"WITH {PAGES_SQL} SELECT page_id, content FROM assembled")
def assemble_documents(spark, sf_dir):
    return page_documents(spark, sf_dir).select("page_id", "content")


@query(
    "extraction_gate",
    f"""WITH {PAGES_SQL}, s AS (
  SELECT count(*) AS total_rows, count(*) FILTER (title IS NULL OR title = 'N/A') AS n_missing_title,
         count(*) FILTER (heading IS NULL OR heading = 'N/A') AS n_missing_heading,
         round(avg(length(content))) AS avg_content_chars, min(length(content)) AS min_content_chars,
         max(length(content)) AS max_content_chars FROM assembled)
SELECT *, total_rows > 0 AND n_missing_title = 0 AND n_missing_heading = 0 AND min_content_chars >= 60 AS passed FROM s""",
)
def extraction_gate(spark, sf_dir):
    required = ["title", "heading"]
    return D.extraction_gate(D.extraction_summary(page_documents(spark, sf_dir), "content", required), required, 60)


LANGUAGE_WORDS = {
    "en": ("the", "of", "and", "that", "is"),
    "de": ("der", "die", "und", "ein", "ist"),
    "es": ("el", "los", "que", "una", "con"),
    "fr": ("le", "la", "et", "des", "est"),
}


def _score_sql(vocabulary):
    return "len(list_filter(w, lambda x: x IN (" + ", ".join(f"'{v}'" for v in vocabulary) + ")))"


@query(
    "classify_documents",
    f"""WITH bags AS (SELECT doc_id, {WORDS_SQL.format('text')} AS w FROM documents),
scores AS (
  SELECT doc_id, {', '.join(f'{_score_sql(v)} AS s_{k}' for k, v in LANGUAGE_WORDS.items())} FROM bags
),
best AS (SELECT *, greatest(s_en, s_de, s_es, s_fr) AS top FROM scores)
SELECT doc_id, CASE WHEN top = 0 THEN 'UNCLASSIFIED' WHEN s_en = top THEN 'en' WHEN s_de = top THEN 'de'
  WHEN s_es = top THEN 'es' ELSE 'fr' END AS category, CAST(top AS INTEGER) AS category_score FROM best""",
)
def classify_documents(spark, sf_dir):
    docs = V.table(spark, sf_dir, "documents").select("doc_id", "text")
    return D.classify(docs, "text", LANGUAGE_WORDS).drop("text")


@query(
    "policy_test",
    r"""SELECT source, count(*) AS documents,
count(*) FILTER (regexp_matches(text, '(?i)copyright|licen[cs]e|all rights reserved')
  AND NOT regexp_matches(text, '(?i)public domain|cc0')) AS restricted FROM documents GROUP BY 1""",
)
def policy_test(spark, sf_dir):
    """A yes-or-no rule over each whole document, totalled per source."""
    restricted = D.policy_test(
        F.col("text"), ["copyright", "licen[cs]e", "all rights reserved"], ["public domain", "cc0"]
    )
    return V.table(spark, sf_dir, "documents").groupBy("source").agg(
        F.count(F.lit(1)).alias("documents"), F.count_if(restricted).alias("restricted")
    )


@query(
    "concept_lookup",
    """WITH concepts AS (
  SELECT d.doc_id AS concept_id, lang AS category, source || ', ' || lang AS related_error_codes, quality = 1 AS certified
  FROM documents d JOIN labels l ON l.doc_id = d.doc_id),
codes AS (SELECT DISTINCT lang AS code FROM documents WHERE lang <> 'en')
SELECT concept_id, category, related_error_codes, certified, trim(c) AS related_code
FROM (SELECT *, unnest(string_split(related_error_codes, ',')) AS c FROM concepts WHERE certified)
WHERE trim(c) IN (SELECT code FROM codes)""",
)
def concept_lookup(spark, sf_dir):
    """Certified documents by code: their source and language serve as codes."""
    docs = V.table(spark, sf_dir, "documents")
    concepts = docs.join(V.table(spark, sf_dir, "labels"), "doc_id").select(
        F.col("doc_id").alias("concept_id"),
        F.col("lang").alias("category"),
        F.concat_ws(", ", "source", "lang").alias("related_error_codes"),
        (F.col("quality") == 1).alias("certified"),
    )
    codes = docs.filter("lang <> 'en'").select(F.col("lang").alias("code"))
    return D.concept_lookup(concepts, codes)


@query(
    "citation_links",
    "SELECT page_id, regexp_replace('gs://' || substr(url, 9), '^gs://', 'https://files.example/') AS link FROM pages",
)
def citation_links(spark, sf_dir):
    uri = F.concat(F.lit("gs://"), F.substring("url", 9, 1 << 30))
    return V.table(spark, sf_dir, "pages").select("page_id", https_link(uri, "https://files.example").alias("link"))


TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
OBJECTS_SQL = ", ".join(f"('{t}')" for t in TABLE_NAMES)


@query("object_table", f"SELECT document_filename, TRUE AS has_bytes FROM (VALUES {OBJECTS_SQL}) AS t(document_filename)")
def object_table(spark, sf_dir):
    """The test tables' own files, listed as objects; their sizes are for the file system to say."""
    files = D.file_corpus(spark, sf_dir, "parquet")
    return files.select("document_filename", (F.col("n_bytes") > 0).alias("has_bytes"))


@query(
    "vector_cosine",
    """SELECT a.vec_id, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS cosine,
len(a.embedding) = 64 AS has_width FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""",
)
def vector_cosine(spark, sf_dir):
    """Column arithmetic on vectors: the cosine of each vector and the next one, and whether its width is the model's."""
    a = V.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    b = a.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("next"))
    cosine = numbers.cosine_similarity(F.col("embedding"), F.col("next"))
    return a.join(b, "vec_id").select(
        "vec_id", F.round(cosine, 6).alias("cosine"), numbers.has_dimension(F.col("embedding"), 64).alias("has_width")
    )


PROBES = 24


@query(
    "vector_index_recall",
    """SELECT item_id AS query_id, 3 AS wanted, TRUE AS ranked_exactly, TRUE AS recall_reached FROM benchmark
WHERE len(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) > 0""",
)
def vector_index_recall(spark, sf_dir):
    """Every question against the chunks' inverted file. Of each question: how many rows the exact search finds; whether the
    distances of the rows that both find agree; and whether the questions together find at least 95 % of them."""
    from aislewise.operators import vector_index
    from aislewise.session import shared_dir

    chunks, asked = embedded_chunks(spark, sf_dir), S.embed(questions(spark, sf_dir), F.col("query"))
    keys = ["doc_id", "chunk_index"]
    index = vector_index.build(chunks, f"{shared_dir(spark)}/ivf-{uuid.uuid4().hex}", keys)
    found = vector_index.search(index, asked, 3, PROBES).withColumnRenamed("distance", "found_distance")
    exact = S.vector_search(chunks.filter(F.array_max("embedding") > 0), asked, keys, 3)
    met = exact.join(found.select("query_id", *keys, "found_distance"), ["query_id", *keys], "left").groupBy("query_id").agg(
        F.count(F.lit(1)).cast("int").alias("wanted"),
        F.count("found_distance").alias("hits"),
        F.every(F.coalesce(F.col("found_distance") == F.col("distance"), F.lit(True))).alias("ranked_exactly"),
    )
    met = cut_lineage(met)
    share = met.agg(F.try_divide(F.sum("hits"), F.sum("wanted"))).scalar()
    return met.select("query_id", "wanted", "ranked_exactly", (share >= 0.95).alias("recall_reached"))
