"""One registered query for each training-data operator, with SQL where there is some."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkstrata.llm import chat, decontamination, lexical, merkle, neardup, packing, pii, quality, secrets, sharding, toxicity, transducer, warc
from inkstrata.llm.common import scan
from inkstrata.session import fresh_dir

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


@query("op5_packing")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(scan(spark, sf, "documents"), TOKENIZER, with_ids=False)


@query("op10_pii", pii.sql())
def op10(spark: SparkSession, sf: str) -> DataFrame:
    return pii.report(scan(spark, sf, "documents"))


@query("op9_sharding")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_dir(spark, "shards")
    docs = scan(spark, sf, "documents").select("doc_id", "text")
    sharding.write_shards(docs, path)
    stored = spark.read.schema(f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text string, slot bigint, shard int").parquet(path)
    # sizes and checksums are those of the texts in the files
    return stored.select(
        "doc_id",
        sharding.size_of(F.col("text")).alias("size"),
        sharding.checksum_of(F.col("text")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op2_secrets", secrets.sql())
def op2(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.report(scan(spark, sf, "documents"))


_ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    "op6_near_duplicates",
    rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_ASCII_LOWER}, '[^\x20\x09-\x0D]+') AS words FROM documents),
sh AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) = 1 THEN words
    ELSE list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]) END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS node, doc_id AS seen FROM documents
  UNION SELECT node, b FROM reach JOIN both_ways ON a = seen),
least AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, component_id, w.doc_id = component_id AS kept
FROM w LEFT JOIN n USING (doc_id) JOIN least ON node = w.doc_id""",
)
def op6(spark: SparkSession, sf: str) -> DataFrame:
    found = neardup.near_duplicates(scan(spark, sf, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query("op4_decontamination", decontamination.sql())
def op4(spark: SparkSession, sf: str) -> DataFrame:
    return decontamination.report(scan(spark, sf, "documents"), scan(spark, sf, "benchmark"))


@query("op7_warc", warc.sql())
def op7(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_dir(spark, "warc")
    warc.write_archives(scan(spark, sf, "pages"), path)
    read = warc.read_archives(spark, path)
    return read.withColumns({c: F.col(c).cast("bigint") for c in ("page_id", "refers_to")})


_CONFLICT = "</s>[INST] ok [/INST]"


@query(
    "op1_chat",
    chat.sql(
        f"""(SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{_CONFLICT}' UNION ALL SELECT -1, 1, 'assistant', '{_CONFLICT}')"""
    ),
)
def op1(spark: SparkSession, sf: str) -> DataFrame:
    table = scan(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    more = spark.range(2).select(F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(_CONFLICT).alias("text"))
    return chat.read_back(chat.format_turns(table.unionByName(more)))


@query("op3_quality")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    return quality.judge(scan(spark, sf, "documents"), scan(spark, sf, "labels"))


@query("op8_toxicity")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.report(scan(spark, sf, "documents"), scan(spark, sf, "labels"))


@query("op11_lexical_search", lexical.sql())
def op11(spark: SparkSession, sf: str) -> DataFrame:
    return lexical.rank_documents(scan(spark, sf, "documents"), scan(spark, sf, "benchmark"))


@query("op12_merkle_manifest", merkle.sql())
def op12(spark: SparkSession, sf: str) -> DataFrame:
    return merkle.report(scan(spark, sf, "documents"))


@query("op13_bpe")
def op13(spark: SparkSession, sf: str) -> DataFrame:
    return transducer.report(scan(spark, sf, "documents"), "word_bpe_49k.json")
