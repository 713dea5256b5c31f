"""Queries: search, prompts, citations."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkstrata.catalog.base import (
    CHUNKER, KEYWORDS, SQL_PATHS, document_chunks, query, sql_chunks, sql_cosine, sql_counts, sql_strip, table, with_paths,
)
from inkstrata.catalog.ingest import SQL_FIRST, first_vectors, vectors
from inkstrata.functions import text as tx
from inkstrata.functions import vectors as vx
from inkstrata.operators import answering, search
from inkstrata.plans import jobs
from inkstrata.session import cut_lineage

SQL_SCORED = f"""
{SQL_PATHS}, {sql_chunks('paths', 'doc_id, file_path, "commit"')},
vecs AS (SELECT *, {sql_counts('content')} AS v FROM chunks),
asked AS (SELECT item_id, text AS question, {sql_counts('text')} AS q FROM benchmark),
scored AS (SELECT item_id, question, doc_id, chunk_index, content, file_path, "commit",
  round({sql_cosine('v', 'q')}, 6) AS score FROM asked CROSS JOIN vecs),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id DESC, chunk_index DESC)
  AS INTEGER) AS "rank" FROM scored)"""


def encode(c):
    return vx.keyword_embedding(c, KEYWORDS)


def questions(spark, sf):
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("question"))


def hits(spark, sf, k):
    chunks = document_chunks(spark, sf).select("doc_id", "chunk_index", encode(F.col("content")).alias("embedding"))
    asked = questions(spark, sf).select("query_id", encode(F.col("question")).alias("embedding"))
    return search.top_k(asked, chunks, k, len(KEYWORDS), position=["doc_id", "chunk_index"], digits=6)


def found_texts(spark, sf, k):
    # few rows, needed twice: as the lookup and as the list of documents
    found = cut_lineage(hits(spark, sf, k))
    docs = with_paths(table(spark, sf, "documents")).select("doc_id", "text", "file_path", "commit")
    store = search.named_rows(docs, found, "doc_id")
    from inkstrata.operators import chunking

    chunks = chunking.drop_blank(chunking.chunk(store, CHUNKER))
    return search.attach_hits(found, chunks, ["doc_id", "chunk_index"])


@query(
    "h1_top_k",
    f"""WITH {SQL_SCORED} SELECT item_id AS query_id, doc_id, CAST(chunk_index AS BIGINT) AS chunk_index, score, "rank"
    FROM ranked WHERE "rank" <= 10""",
)
def _(spark, sf):
    return hits(spark, sf, 10)


def sql_vector_hits(score: str, k: int) -> str:
    return f"""WITH {SQL_FIRST}, scored AS (
      SELECT label AS query_id, vec_id, round({score}, 6) AS score
      FROM firsts CROSS JOIN (SELECT vec_id, v FROM vectors))
    SELECT CAST(query_id AS BIGINT) AS query_id, vec_id, score, CAST("rank" AS INTEGER) AS "rank" FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id DESC) AS "rank" FROM scored)
    WHERE "rank" <= {k}"""


def vector_hits(spark, sf, k, metric, **kwargs):
    asked = first_vectors(spark, sf).select(F.col("label").alias("query_id"), F.col("q").alias("embedding"))
    stored = vectors(spark, sf).withColumnRenamed("v", "embedding")
    return search.top_k(asked, stored, k, 64, position=["vec_id"], metric=metric, digits=6, **kwargs)


@query("e2_search_cosine", sql_vector_hits("list_cosine_similarity(v, q)", 20))
def _(spark, sf):
    return vector_hits(spark, sf, 20, "cosine")


@query("e2_search_inner_product", sql_vector_hits("list_dot_product(v, q)", 20))
def _(spark, sf):
    return vector_hits(spark, sf, 20, "ip")


@query("e2_search_in_blocks", sql_vector_hits("list_cosine_similarity(v, q)", 20))
def _(spark, sf):
    # the form for query tables that are too large to broadcast
    return vector_hits(spark, sf, 20, "cosine", broadcast_numbers=256)


@query("d9_query_table", sql_vector_hits("list_cosine_similarity(v, q)", 5))
def _(spark, sf):
    return vector_hits(spark, sf, 5, "cosine")


@query(
    "e3_hit_lookup",
    f"""WITH {SQL_SCORED} SELECT item_id AS query_id, "rank", file_path, coalesce("commit", 'HEAD') AS "commit", content, score
    FROM ranked WHERE "rank" <= 4""",
)
def _(spark, sf):
    return found_texts(spark, sf, 4).select(
        "query_id", "rank", "file_path", F.coalesce("commit", F.lit("HEAD")).alias("commit"), "content", "score"
    )


@query(
    "g5_hit_labels",
    f"""WITH {SQL_SCORED} SELECT item_id AS query_id, '[' || "rank" || ']' AS label, doc_id FROM ranked WHERE "rank" <= 4""",
)
def _(spark, sf):
    label = F.concat(F.lit("["), F.col("rank").cast("string"), F.lit("]"))
    return hits(spark, sf, 4).select("query_id", label.alias("label"), "doc_id")


SQL_CONTEXT = f"""
blocks AS (SELECT item_id, question, string_agg('[' || "rank" || '] (' || file_path || '@' || coalesce("commit", 'HEAD') || ')'
    || chr(10) || content, chr(10) || chr(10) ORDER BY "rank") AS context,
  string_agg('[' || "rank" || '] ' || file_path || '@' || coalesce("commit", 'HEAD') || printf(' (score=%.3f)', score),
    chr(10) ORDER BY "rank") AS citations
  FROM ranked WHERE "rank" <= 4 GROUP BY item_id, question),
prompts AS (SELECT item_id, E'You are a security-cleared assistant that must cite your sources.\\nContext:\\n' || context
    || E'\\n\\nUser question: ' || question || E'\\nAssistant:' AS prompt, citations FROM blocks)"""


def answers(spark, sf, generator=None):
    docs = with_paths(table(spark, sf, "documents")).select("doc_id", "text", "file_path", "commit")
    return jobs.answer_questions(
        questions(spark, sf), docs, CHUNKER, encode, len(KEYWORDS), digits=6, generator=generator
    )


@query(
    "c9_retrieval_prompt",
    f"WITH {SQL_SCORED}, {SQL_CONTEXT} SELECT item_id AS query_id, prompt FROM prompts",
)
def _(spark, sf):
    found = found_texts(spark, sf, 4)
    return answering.assemble_answers(questions(spark, sf), found).select("query_id", "prompt")


@query(
    "c9_prompt_without_context",
    r"""SELECT item_id AS query_id, E'You are a security-cleared assistant that must cite your sources.\nContext:\n'
      || E'No context available.\n\nUser question: ' || text || E'\nAssistant:' AS prompt,
      'No citations available.' AS citations FROM benchmark""",
)
def _(spark, sf):
    asked = questions(spark, sf).select("query_id", encode(F.col("question")).alias("embedding"))
    # labels are not negative, so this index is empty
    empty = (
        vectors(spark, sf).where(F.col("label") < 0)
        .select("vec_id", F.slice("v", 1, len(KEYWORDS)).alias("embedding"))
    )
    none = search.top_k(asked, empty, 4, len(KEYWORDS), position=["vec_id"]).select(
        "query_id", "rank", F.lit("").alias("content"), F.lit("").alias("file_path"), F.lit("").alias("commit"), "score"
    )
    answered = answering.assemble_answers(questions(spark, sf), none)
    return answered.select("query_id", "prompt", answering.citation_report(F.col("citations")).alias("citations"))


@query(
    "c10_citations",
    f"WITH {SQL_SCORED}, {SQL_CONTEXT} SELECT item_id AS query_id, citations FROM prompts",
)
def _(spark, sf):
    found = found_texts(spark, sf, 4)
    answered = answering.assemble_answers(questions(spark, sf), found)
    return answered.select("query_id", answering.citation_report(F.col("citations")).alias("citations"))


SQL_QA_PROMPT = r"'Question: ' || u.text || E'\nContext: ' || a.text || E'\nAnswer:'"


@query(
    "c11_qa_prompt_and_completion",
    f"""SELECT u.conv_id, u.turn, {SQL_QA_PROMPT} AS prompt, {sql_strip('a.text')} AS answer,
      ' ' || a.text || chr(10) AS completion
    FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
    WHERE u.role = 'user' AND a.role = 'assistant'""",
)
def _(spark, sf):
    from inkstrata.operators import examples

    pairs = examples.instruction_pairs(table(spark, sf, "conversations"))
    prompted = pairs.withColumn("prompt", tx.qa_prompt(F.col("prompt"), F.col("response")))
    output = F.concat("prompt", F.lit(" "), "response", F.lit("\n"))
    completion = tx.completion_after(output, F.col("prompt"))
    return prompted.select(
        "conv_id", "turn", "prompt", tx.strip(completion).alias("answer"), completion.alias("completion")
    )


@query(
    "c13_text_after_marker",
    f"""SELECT conv_id, turn, {sql_strip("'x ' || text")} AS answer, '' AS nothing FROM conversations""",
)
def _(spark, sf):
    marked = F.concat(F.lit("User: hi\nAssistant: no\nAssistant: x "), "text")
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", tx.text_after_marker(marked).alias("answer"),
        tx.text_after_marker(F.concat("text", F.lit("\nAssistant:"))).alias("nothing"),
    )


def last_line(prompt: str) -> str:
    """A caller's generator, as it would be handed to the library."""
    return prompt.split("\n")[-2].lower()


@query(
    "l2_user_generator",
    "SELECT item_id AS query_id, lower('User question: ' || string_split(text, chr(10))[-1]) AS answer FROM benchmark"
    " WHERE text NOT LIKE '%' || chr(10) || '%' UNION ALL "
    "SELECT item_id, lower(string_split(text, chr(10))[-1]) FROM benchmark WHERE text LIKE '%' || chr(10) || '%'",
)
def _(spark, sf):
    return answers(spark, sf, last_line).select("query_id", "answer")


@query(
    "n3_question_answering",
    f"""WITH {SQL_SCORED}, {SQL_CONTEXT} SELECT item_id AS query_id, b.text AS question, prompt, '' AS answer, citations
    FROM prompts JOIN benchmark b USING (item_id)""",
)
def _(spark, sf):
    return answers(spark, sf).withColumn("citations", answering.citation_report(F.col("citations")))
