"""Queries: documents to index rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkstrata.catalog.base import (
    CHUNKER, KEYWORDS, SQL_PATHS, document_chunks, query, sql_chunks, sql_counts, sql_strip, table, with_paths,
)
from inkstrata.functions import text as tx
from inkstrata.functions import vectors as vx
from inkstrata.operators import answering, chunking, evaluation, ingest, sinks
from inkstrata.operators.skew import lookup_join
from inkstrata.session import fresh_dir
from inkstrata.sources import files, listing


def count_keywords(texts: list[str]) -> list[list[float]]:
    """A caller's encoder, as it would be handed to the library."""
    return [[float(t.lower().count(k)) for k in KEYWORDS] for t in texts]


def binary_files(spark, sf):
    """Documents and pages as files: some of an unknown type, some not UTF-8."""
    key = F.col("doc_id")
    suffix = F.when(key % 7 == 0, ".txt").when(key % 7 == 1, ".MD").when(key % 7 == 2, ".markdown").otherwise(".md")
    body = F.encode(F.replace("text", F.lit("\n"), F.lit("\r\n")), "UTF-8")
    docs = table(spark, sf, "documents").select(
        F.concat(F.when(key % 13 == 5, "docs/_").otherwise("docs/"), key.cast("string"), suffix).alias("path"),
        F.when(key % 11 == 0, F.concat(F.unhex(F.lit("FF")), body)).otherwise(body).alias("content"),
    )
    pages = table(spark, sf, "pages").select(
        F.concat(F.lit("pages/"), F.col("page_id").cast("string"), F.lit(".html")).alias("path"),
        F.encode("html", "UTF-8").alias("content"),
    )
    return docs.unionByName(pages)


def scanned_files(spark, sf):
    """The files written to a folder and read from it: hidden names, other types and other bytes among them."""
    root = fresh_dir(spark, "files").removeprefix("file:")
    listing.write_files(binary_files(spark, sf), root)
    found = files.read_documents(spark, root)
    return found.withColumn("path", F.expr(f"substr(path, {len(root) + 2})"))


SQL_FILES = """
files AS (
  SELECT 'docs/' || CASE doc_id % 13 WHEN 5 THEN '_' ELSE '' END || doc_id || CASE doc_id % 7 WHEN 0 THEN '.txt' WHEN 1 THEN '.MD' WHEN 2 THEN '.markdown' ELSE '.md' END
    AS path, 'markdown' AS converter, text FROM documents WHERE doc_id % 7 <> 0 AND doc_id % 11 <> 0
  UNION ALL SELECT 'pages/' || page_id || '.html', 'html', html FROM pages)"""


def sql_page_text(x: str) -> str:
    """Text of a page that has one script section, outside of which tags are plain."""

    def decoded(part: str) -> str:
        plain = f"regexp_replace(regexp_replace({part}, '<!--.*?-->', '', 'gs'), '<[^>]*>', chr(1), 'g')"
        for entity, char in (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"')):
            plain = f"replace({plain}, '{entity}', '{char}')"
        return f"replace(regexp_replace({plain}, '&amp;?', '&', 'g'), chr(1), '')"

    start, end = f"strpos({x}, '<script>')", f"strpos({x}, '</script>')"
    return (
        f"{decoded(f'substr({x}, 1, {start} - 1)')} || substr({x}, {start} + 8, {end} - {start} - 8) || "
        f"{decoded(f'substr({x}, {end} + 9)')}"
    )


@query("a10_document_scan", f"WITH {SQL_FILES} SELECT path, converter, text FROM files")
def _(spark, sf):
    return scanned_files(spark, sf)


@query(
    "a11_converter_dispatch",
    """SELECT converter, count(*) AS files FROM (
      SELECT CASE WHEN doc_id % 7 = 0 THEN 'none' ELSE 'markdown' END AS converter FROM documents
      UNION ALL SELECT 'html' FROM pages) GROUP BY converter""",
)
def _(spark, sf):
    name = F.coalesce(ingest.converter_name(F.col("path")), F.lit("none"))
    return binary_files(spark, sf).groupBy(name.alias("converter")).agg(F.count(F.lit(1)).alias("files"))


@query("c8_html_to_text", f"SELECT page_id, {sql_page_text('html')} AS text FROM pages")
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", ingest.html_to_text("html").alias("text"))


SQL_LENGTHS = """
sized AS (
  SELECT doc_id, 0 AS cut, text FROM documents
  UNION ALL SELECT doc_id, 1, substr(text, 1, doc_id % 1000) FROM documents
  UNION ALL SELECT doc_id, 2, substr(repeat(text, 2), 1, 1480) FROM documents
  UNION ALL SELECT doc_id, 3, replace(text, 'e', '𝄞') FROM documents)"""


@query(
    "d1_sliding_windows",
    f"""WITH {SQL_LENGTHS},
    n AS (SELECT doc_id, cut, text, CASE WHEN length(text) = 0 THEN 0 WHEN length(text) <= 800 THEN 1
      ELSE 1 + CAST(ceil((length(text) - 800) / 680.0) AS BIGINT) END AS n FROM sized),
    i AS (SELECT doc_id, cut, text, unnest(range(0, n)) AS i FROM n)
    SELECT doc_id, cut, CAST(i AS INTEGER) AS chunk_index, substr(text, i * 680 + 1, 800) AS content FROM i""",
)
def _(spark, sf):
    docs = table(spark, sf, "documents")

    def cut(kind, text):
        return docs.select("doc_id", F.lit(kind).alias("cut"), text.alias("text"))

    sized = (
        cut(0, F.col("text"))
        .unionByName(cut(1, F.substring("text", F.lit(1), (F.col("doc_id") % 1000).cast("int"))))
        .unionByName(cut(2, F.substring(F.repeat("text", F.lit(2)), 1, 1480)))
        .unionByName(cut(3, F.replace("text", F.lit("e"), F.lit("𝄞"))))
    )
    return chunking.chunk(sized, CHUNKER)


@query(
    "d2_window_parameters",
    """SELECT 'size 512 overlap 64' AS setting, CAST(sum(CASE WHEN length(text) = 0 THEN 0 WHEN length(text) <= 512 THEN 1
        ELSE 1 + CAST(ceil((length(text) - 512) / 448.0) AS BIGINT) END) AS BIGINT) AS windows, '' AS error FROM documents
    UNION ALL SELECT 'size 0 overlap 0', 0, 'chunk size must be positive'
    UNION ALL SELECT 'size 64 overlap -1', 0, 'chunk overlap must not be negative'
    UNION ALL SELECT 'size 64 overlap 64', 0, 'chunk overlap must be smaller than the chunk size'""",
)
def _(spark, sf):
    docs = table(spark, sf, "documents")
    rows = []
    for size, overlap in ((512, 64), (0, 0), (64, -1), (64, 64)):
        windows, error = F.lit(0).cast("bigint"), ""
        try:
            windows = F.sum(chunking.Chunker(size, overlap).count(F.col("text")))
        except ValueError as problem:
            error = str(problem)
        setting = F.lit(f"size {size} overlap {overlap}")
        rows.append(
            docs.agg(F.count(F.lit(1)).alias("_"), (windows + 0 if error == "" else F.max(windows)).alias("windows")).select(
                setting.alias("setting"), "windows", F.lit(error).alias("error")
            )
        )
    result = rows[0]
    for row in rows[1:]:
        result = result.unionByName(row)
    return result


SQL_BLANKED = """
blanked AS (SELECT doc_id, replace(text, '.', '.' || repeat(' ', 130)) || repeat(' ', 900) AS text FROM documents)"""


@query(
    "c6_drop_blank_chunks",
    f"WITH {SQL_BLANKED}, {sql_chunks('blanked', 'doc_id', 64, 8)} SELECT doc_id, chunk_index, content FROM chunks",
)
def _(spark, sf):
    blanked = table(spark, sf, "documents").select(
        "doc_id", F.concat(F.replace("text", F.lit("."), F.lit("." + " " * 130)), F.lit(" " * 900)).alias("text")
    )
    return chunking.drop_blank(chunking.chunk(blanked, chunking.Chunker(64, 8)))


@query(
    "c7_metadata_defaults",
    """SELECT doc_id, 'docs/' || doc_id || '.Md' AS file_path, CASE WHEN doc_id % 2 = 1 THEN source ELSE 'unknown' END AS repo,
      'abc123' AS "commit", 'Md' AS source, CASE WHEN doc_id % 2 = 1 THEN lang ELSE '-' END AS lang FROM documents""",
)
def _(spark, sf):
    base = F.when(
        F.col("doc_id") % 2 == 1, F.create_map(F.lit("repo"), F.col("source"), F.lit("lang"), F.col("lang"))
    )
    path = F.concat(F.lit("docs/"), F.col("doc_id").cast("string"), F.lit(".Md"))
    meta = ingest.build_metadata(path, base, commit="abc123")
    return table(spark, sf, "documents").select("doc_id", meta.alias("m")).select(
        "doc_id",
        *[F.col("m")[k].alias(k) for k in ingest.METADATA_KEYS],
        F.coalesce(F.col("m")["lang"], F.lit("-")).alias("lang"),
    )


SQL_DIGEST = """
digests AS (SELECT doc_id, sha256(text) AS h FROM documents),
bytes AS (SELECT doc_id, list_transform(range(0, 32), lambda i:
    CAST((instr('0123456789abcdef', substr(h, 2 * i + 1, 1)) - 1) * 16
      + instr('0123456789abcdef', substr(h, 2 * i + 2, 1)) - 1 AS DOUBLE)) AS b FROM digests)"""


@query(
    "d3_digest_embedding",
    f"""WITH {SQL_DIGEST}, n AS (SELECT doc_id, b, sqrt(24 * list_dot_product(b, b)) AS norm FROM bytes)
    SELECT doc_id, 768 AS dim, round(b[1] / norm, 9) AS first, round(b[32] / norm, 9) AS last,
      round(24 * list_sum(b) / norm, 6) AS total, 1.0 AS norm FROM n""".replace("1.0 AS norm FROM", "CAST(1 AS DOUBLE) AS norm FROM"),
)
def _(spark, sf):
    v = F.col("v")
    return (
        table(spark, sf, "documents")
        .select("doc_id", vx.digest_embedding(F.col("text")).alias("v"))
        .select(
            "doc_id",
            F.size(v).alias("dim"),
            F.round(v[0], 9).alias("first"),
            F.round(F.element_at(v, -1), 9).alias("last"),
            F.round(F.aggregate(v, F.lit(0.0), lambda a, x: a + x), 6).alias("total"),
            F.round(vx.norm(v), 6).alias("norm"),
        )
    )


@query(
    "d4_keyword_embedding",
    f"""SELECT doc_id, array_to_string(list_transform({sql_counts('text')}, lambda x: CAST(x AS BIGINT)), ' ') AS counts
    FROM documents""",
)
def _(spark, sf):
    counts = vx.keyword_embedding(F.col("text"), KEYWORDS)
    return table(spark, sf, "documents").select(
        "doc_id", F.array_join(F.transform(counts, lambda x: x.cast("bigint").cast("string")), " ").alias("counts")
    )


SQL_FIRST = """
vectors AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
firsts AS (SELECT label, arg_min(v, vec_id) AS q FROM vectors GROUP BY label)"""


def vectors(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", "label", vx.as_doubles(F.col("embedding")).alias("v"))


def first_vectors(spark, sf):
    """The first vector of each label: a small query table taken from the data."""
    return vectors(spark, sf).groupBy("label").agg(F.min_by("v", "vec_id").alias("q"))


@query(
    "d5_normalize",
    """SELECT vec_id, round(sqrt(list_dot_product(v, v)), 6) AS norm, round(v[1] / sqrt(list_dot_product(v, v)), 6) AS head,
      round(list_sum(v) / sqrt(list_dot_product(v, v)), 6) AS total
    FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)""",
)
def _(spark, sf):
    unit = vx.normalize(F.col("v"))
    return vectors(spark, sf).select(
        "vec_id",
        F.round(vx.norm(F.col("v")), 6).alias("norm"),
        F.round(unit[0], 6).alias("head"),
        F.round(F.aggregate(unit, F.lit(0.0), lambda a, x: a + x), 6).alias("total"),
    )


def with_first(spark, sf):
    # labels may be few and large, so the lookup is spread
    return lookup_join(vectors(spark, sf), first_vectors(spark, sf), ["label"], ["vec_id"])


@query(
    "d6_dot_product",
    f"WITH {SQL_FIRST} SELECT vec_id, round(list_dot_product(v, q), 6) AS score FROM vectors JOIN firsts USING (label)",
)
def _(spark, sf):
    return with_first(spark, sf).select("vec_id", F.round(vx.dot(F.col("v"), F.col("q")), 6).alias("score"))


@query(
    "d7_cosine_score",
    f"WITH {SQL_FIRST} SELECT vec_id, round(list_cosine_similarity(v, q), 6) AS score FROM vectors JOIN firsts USING (label)",
)
def _(spark, sf):
    return with_first(spark, sf).select("vec_id", F.round(vx.cosine(F.col("v"), F.col("q")), 6).alias("score"))


@query("d8_dimension_check", "SELECT vec_id, CAST(len(embedding) AS INTEGER) AS dim FROM embeddings")
def _(spark, sf):
    return vectors(spark, sf).select("vec_id", F.size(vx.checked(F.col("v"), 64)).alias("dim"))


@query(
    "e1_positional_zip",
    """WITH d AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS p FROM documents),
    e AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS p FROM embeddings)
    SELECT doc_id, vec_id FROM d JOIN e USING (p)""",
)
def _(spark, sf):
    return evaluation.positional_zip(
        table(spark, sf, "documents").select("doc_id"), table(spark, sf, "embeddings").select("vec_id"),
        ["doc_id"], ["vec_id"],
    )


@query(
    "e6_run_metadata",
    f"""WITH {sql_chunks('documents', 'doc_id')}
    SELECT doc_id, chunk_index, 'local' AS repo, 'abc123' AS "commit", length(content) AS chars FROM chunks""",
)
def _(spark, sf):
    run = F.create_map(F.lit("repo"), F.lit("local"), F.lit("commit"), F.lit("abc123"))
    tagged = document_chunks(spark, sf).withColumn("metadata", run)
    return tagged.select(
        "doc_id", "chunk_index", F.col("metadata")["repo"].alias("repo"), F.col("metadata")["commit"].alias("commit"),
        F.length("content").cast("bigint").alias("chars"),
    )


@query(
    "f1_chunk_counts",
    f"""WITH {SQL_PATHS}, {sql_chunks('paths', 'file_path')}
    SELECT coalesce(file_path, 'total') AS file_path, count(*) AS chunks FROM chunks GROUP BY ROLLUP (file_path)""",
)
def _(spark, sf):
    docs = with_paths(table(spark, sf, "documents")).select("file_path", "text")
    chunks = chunking.drop_blank(chunking.chunk(docs, CHUNKER))
    return (
        chunks.rollup("file_path").agg(F.count(F.lit(1)).alias("chunks"))
        .withColumn("file_path", F.coalesce("file_path", F.lit("total")))
    )


SQL_INDEX = f"""
{SQL_FILES},
texts AS (SELECT path, CASE converter WHEN 'html' THEN {sql_page_text('text')} ELSE text END AS text FROM files),
{sql_chunks('texts', 'path')},
index_rows AS (SELECT path, chunk_index, content, path AS file_path, 'local' AS repo, 'abc123' AS "commit",
  regexp_extract(path, '[^.]+$') AS source FROM chunks)"""


def index_of(spark, sf):
    request = F.create_map(F.lit("repo"), F.lit("local"), F.lit("commit"), F.lit("abc123"))
    return ingest.ingest(scanned_files(spark, sf), CHUNKER, lambda c: vx.keyword_embedding(c, KEYWORDS), request)


@query(
    "b2_index_export",
    f'WITH {SQL_INDEX} SELECT content AS text, file_path, repo, "commit", source FROM index_rows',
)
def _(spark, sf):
    path = fresh_dir(spark, "export")
    sinks.write_json(sinks.index_export(index_of(spark, sf)), path)
    back = spark.read.schema("text string, metadata map<string,string>").json(path)
    return back.select("text", *[F.col("metadata")[k].alias(k) for k in ingest.METADATA_KEYS])


@query(
    "i2_index_append",
    f"""WITH {sql_chunks('documents', 'doc_id')}
    SELECT doc_id, chunk_index, CAST(2 AS BIGINT) AS copies FROM chunks""",
)
def _(spark, sf):
    path = fresh_dir(spark, "index")
    for _ in range(2):
        document_chunks(spark, sf).write.mode("append").parquet(path)
    return spark.read.parquet(path).groupBy("doc_id", "chunk_index").agg(F.count(F.lit(1)).alias("copies"))


@query(
    "l1_user_encoder",
    f"""WITH {sql_chunks('documents', 'doc_id')}
    SELECT doc_id, chunk_index,
      array_to_string(list_transform({sql_counts('content')}, lambda x: CAST(x AS BIGINT)), ' ') AS counts FROM chunks""",
)
def _(spark, sf):
    vector = answering.encode_with_built(lambda: count_keywords, F.col("content"))
    return document_chunks(spark, sf).withColumn("v", vector).select(
        "doc_id", "chunk_index",
        F.array_join(F.transform("v", lambda x: x.cast("bigint").cast("string")), " ").alias("counts"),
    )


def paragraphs(text: str) -> list[str]:
    return text.split("\n")


def tag_names(markup: str) -> list[str]:
    return [part.split(">", 1)[0] for part in markup.split("<")[1:]]


@query(
    "l3_user_converters",
    f"""WITH {SQL_FILES}
    SELECT path, CAST(unnest(range(0, len(string_split(text, chr(10))))) AS INTEGER) AS chunk_index,
      unnest(string_split(text, chr(10))) AS content FROM files WHERE converter = 'markdown' AND path LIKE '%.md'
    UNION ALL
    SELECT path, CAST(unnest(range(0, len(string_split(text, '<')) - 1)) AS INTEGER),
      unnest(list_transform(string_split(text, '<')[2:], lambda p: string_split(p, '>')[1]))
    FROM files WHERE converter = 'html'
    UNION ALL
    SELECT path, CAST(unnest(range(0, len(string_split(text, chr(10))))) AS INTEGER),
      unnest(string_split(text, chr(10))) FROM files WHERE path LIKE '%.MD'""",
)
def _(spark, sf):
    decoded = ingest.decode_files(binary_files(spark, sf))
    return ingest.apply_converters(decoded, {".md": paragraphs, ".html": tag_names})


@query(
    "n2_private_ingest",
    f"""WITH {SQL_INDEX} SELECT path, chunk_index, content, repo, "commit", source,
      array_to_string(list_transform({sql_counts('content')}, lambda x: CAST(x AS BIGINT)), ' ') AS counts FROM index_rows""",
)
def _(spark, sf):
    return index_of(spark, sf).select(
        "path", "chunk_index", "content", *[F.col("metadata")[k].alias(k) for k in ("repo", "commit", "source")],
        F.array_join(F.transform("embedding", lambda x: x.cast("bigint").cast("string")), " ").alias("counts"),
    )
