"""Registry of the queries and the derived inputs they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkstrata.operators import chunking
from inkstrata.operators import vocabulary as vb
from inkstrata.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is there already")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf}/{name}.parquet")


# --- the same derived inputs, once for Spark and once for SQL ---------------

SQL_SPACE = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{SQL_SPACE}+|{SQL_SPACE}+$', '', 'g')"


def dirty(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with fences, blank runs and carriage returns put in."""
    text = F.col("text")
    kind = F.col("doc_id") % 5
    return table(spark, sf, "documents").withColumn(
        "text",
        F.when(kind == 1, F.replace(text, F.lit(" "), F.lit("  ")))
        .when(kind == 2, F.concat(F.lit("```python\n    def f(x):\n        return x\n```\n"), text))
        .when(kind == 3, F.concat(F.replace(text, F.lit("\n"), F.lit("\r\n\r\n")), F.lit(" \t")))
        .when(kind == 4, F.concat(text, F.lit("\n```\n```\n```js\n\n  let a = 1;\n\n```")))
        .otherwise(text),
    )


SQL_DIRTY = r"""
dirty AS (
  SELECT doc_id, lang, source,
    CASE doc_id % 5
      WHEN 1 THEN replace(text, ' ', '  ')
      WHEN 2 THEN E'```python\n    def f(x):\n        return x\n```\n' || text
      WHEN 3 THEN replace(text, E'\n', E'\r\n\r\n') || E' \t'
      WHEN 4 THEN text || E'\n```\n```\n```js\n\n  let a = 1;\n\n```'
      ELSE text END AS text
  FROM documents)"""

SQL_TAGGED = (
    r"regexp_replace(text, '(?s)```(?:[a-zA-Z0-9_+-]+\n)?\n*(.*?)\n*```', E'\n<code>\n\\1\n</code>\n', 'g')"
)


def sql_normalized(x: str) -> str:
    return sql_strip(
        r"regexp_replace(regexp_replace(replace(" + x + r", chr(13), chr(10)), '[ \t]{2,}', ' ', 'g'), "
        r"'\n{3,}', E'\n\n', 'g')"
    )


SQL_BLOCKS = (
    r"list_transform(regexp_extract_all(text, '(?s)```(?:[a-zA-Z0-9_+-]+\n)?(.*?)```', 1), "
    f"lambda b: {sql_strip('b')})"
)

SQL_RECORDS = f"""
{SQL_DIRTY},
records AS (
  SELECT doc_id, lang, source, {sql_normalized(SQL_TAGGED)} AS text, {SQL_BLOCKS} AS blocks,
    CASE WHEN doc_id % 3 > 0 THEN 'license-' || (doc_id % 3) END AS license
  FROM dirty)"""


def licensed(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("doc_id") % 3
    return dirty(spark, sf).withColumn(
        "license", F.when(kind > 0, F.concat(F.lit("license-"), kind.cast("string")))
    )


CHUNKER = chunking.Chunker(800, 120)


def sql_chunks(source: str, keys: str, size: int = 800, overlap: int = 120) -> str:
    """Chunks of ``source``: keys, chunk_index and stripped content, blanks left out."""
    step = size - overlap
    return f"""
cut AS (
  SELECT {keys}, unnest(range(0, CASE WHEN length(text) = 0 THEN 0 WHEN length(text) <= {size} THEN 1
      ELSE 1 + CAST(ceil((length(text) - {size}) / {step}.0) AS BIGINT) END)) AS chunk_index, text
  FROM {source}),
chunks AS (
  SELECT {keys}, CAST(chunk_index AS INTEGER) AS chunk_index, {sql_strip(f"substr(text, chunk_index * {step} + 1, {size})")} AS content
  FROM cut
  WHERE length({sql_strip(f"substr(text, chunk_index * {step} + 1, {size})")}) > 0)"""


def document_chunks(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return chunking.drop_blank(chunking.chunk(docs, CHUNKER))


# Keywords of the counting encoder used by the queries.
KEYWORDS = ["the", "and", "ther", "tion", "ing", "der", "que", "ent"]


def sql_counts(x: str) -> str:
    return "[" + ", ".join(
        f"CAST((length(lower({x})) - length(replace(lower({x}), '{k}', ''))) // {len(k)} AS DOUBLE)" for k in KEYWORDS
    ) + "]"


def sql_cosine(a: str, b: str) -> str:
    def unit(v: str) -> str:
        return f"(CASE WHEN list_dot_product({v}, {v}) = 0 THEN 1.0 ELSE sqrt(list_dot_product({v}, {v})) END)"

    return f"list_dot_product({a}, {b}) / ({unit(a)} * {unit(b)})"


def with_paths(docs: DataFrame) -> DataFrame:
    """File metadata of the documents; even ids have no commit of their own."""
    key = F.col("doc_id").cast("string")
    return docs.withColumn("file_path", F.concat(F.lit("docs/"), key, F.lit(".md"))).withColumn(
        "commit", F.when(F.col("doc_id") % 2 == 1, F.concat(F.lit("c"), key))
    )


SQL_PATHS = """
paths AS (
  SELECT *, 'docs/' || doc_id || '.md' AS file_path,
    CASE WHEN doc_id % 2 = 1 THEN 'c' || doc_id END AS "commit" FROM documents)"""

SQL_WORDS = r"regexp_extract_all(text, '[0-9]|[^0-9\t-\r ]+')"

# The reference's vocabulary size, special pieces included.
VOCABULARY = vb.VOCAB_SIZE


def vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    return vb.frequency_vocabulary(vb.count_words(table(spark, sf, "documents")), VOCABULARY)


SQL_VOCABULARY = f"""
word_counts AS (
  SELECT word, count(*) AS n FROM (SELECT unnest({SQL_WORDS}) AS word FROM documents) GROUP BY word),
vocab AS (
  SELECT word AS piece, 3 + row_number() OVER (ORDER BY n DESC, word COLLATE "C") AS id
  FROM word_counts ORDER BY n DESC, word COLLATE "C" LIMIT {VOCABULARY - 4})""".replace(' COLLATE "C"', "")


def sql_encoded(source: str, keys: str) -> str:
    """``keys, ids``: word ids of each text of ``source`` in order."""
    return f"""
placed AS (
  SELECT {keys}, unnest({SQL_WORDS}) AS word, generate_subscripts({SQL_WORDS}, 1) AS pos FROM {source}),
gathered AS (
  SELECT {keys}, list(coalesce(id, 1) ORDER BY pos) AS ids
  FROM placed LEFT JOIN vocab ON word = piece GROUP BY ALL),
encoded AS (
  SELECT {keys}, coalesce(ids, []) AS ids FROM {source} LEFT JOIN gathered USING ({keys}))"""


def joined(column: str):
    return F.array_join(F.transform(column, lambda x: x.cast("string")), " ")


SQL_PAIRS = r"""
pairs AS (
  SELECT u.conv_id, u.turn, u.text AS prompt, a.text AS response,
    E'<s>Instruction:\n' || u.text || E'\n\nResponse:\n' || a.text || '</s>' AS text
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant')"""


def step_log(spark: SparkSession, sf: str) -> DataFrame:
    """Events as the step log of one run per event type."""
    from inkstrata.operators.numbering import number_rows

    events = table(spark, sf, "events").select(
        F.col("event_type").alias("run"), "ts", "event_id", F.col("value").alias("step_time")
    )
    return number_rows(events, ["ts", "event_id"], ["run"], out="step", start=0)


SQL_STEPS = """
steps AS (
  SELECT event_type AS run, event_id, ts, value AS step_time,
    row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS step FROM events)"""
