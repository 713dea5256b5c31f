"""Queries: incremental jobs (K1-K4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkstrata.catalog.base import (
    CHUNKER, KEYWORDS, joined, licensed, query, sql_chunks, sql_counts, table, with_paths,
)
from inkstrata.catalog.corpus import SQL_PROCESSED
from inkstrata.catalog.retrieval import SQL_CONTEXT, SQL_SCORED, encode
from inkstrata.operators import answering, chunking
from inkstrata.plans import jobs
from inkstrata.session import fresh_dir
from inkstrata.sources.tables import deliveries
from inkstrata.streaming import jobs as stream


@query("k1_stream_clean_and_shard", SQL_PROCESSED)
def _(spark, sf):
    base = fresh_dir(spark, "stream")
    raw = licensed(spark, sf).select("doc_id", "text", "license")
    arrived = deliveries(spark, f"{sf}/documents.parquet", 4)
    raw.repartition(arrived).write.parquet(f"{base}/in")
    arriving = stream.file_stream(spark, f"{base}/in", raw.schema, files_per_batch=arrived // 2)
    stream.clean_and_shard(arriving, f"{base}/out", f"{base}/progress", keep=["doc_id"]).awaitTermination()
    return spark.read.parquet(f"{base}/out")


STREAM_SHARD = 70


@query(
    "k1_exact_shards",
    f"""SELECT doc_id, text, 1 + (row_number() OVER (ORDER BY doc_id % 3, doc_id) - 1) // {STREAM_SHARD} AS shard
    FROM ({SQL_PROCESSED})""",
)
def _(spark, sf):
    base = fresh_dir(spark, "stream")
    raw = licensed(spark, sf).select("doc_id", "text", "license")
    # three deliveries, none of which ends with a full shard
    for late in range(3):
        raw.where(F.col("doc_id") % 3 == late).write.mode("append").parquet(f"{base}/in")
        arriving = stream.file_stream(spark, f"{base}/in", raw.schema)
        stream.clean_to_full_shards(arriving, f"{base}/out", f"{base}/progress", ["doc_id"], keep=["doc_id"], shard_size=STREAM_SHARD).awaitTermination()
    stream.flush_shards(spark, f"{base}/out", f"{base}/progress")
    return spark.read.parquet(f"{base}/out").select("doc_id", "text", F.col("shard").cast("bigint").alias("shard"))


@query("k2_stream_restart", SQL_PROCESSED)
def _(spark, sf):
    base = fresh_dir(spark, "stream")
    raw = licensed(spark, sf).select("doc_id", "text", "license")

    def run():
        arriving = stream.file_stream(spark, f"{base}/in", raw.schema)
        stream.clean_and_shard(arriving, f"{base}/out", f"{base}/progress", keep=["doc_id"]).awaitTermination()

    # two deliveries with a stop between them, then a restart that finds nothing new
    for late in (0, 1):
        raw.where(F.col("doc_id") % 2 == late).write.mode("append").parquet(f"{base}/in")
        run()
    run()
    return spark.read.parquet(f"{base}/out")


@query(
    "k3_stream_index_append",
    f"""WITH {sql_chunks('documents', 'doc_id')}
    SELECT 'docs/' || doc_id || '.md' AS file_path, chunk_index, content,
      array_to_string(list_transform({sql_counts('content')}, lambda x: CAST(x AS BIGINT)), ' ') AS counts FROM chunks""",
)
def _(spark, sf):
    base = fresh_dir(spark, "stream")
    files = with_paths(table(spark, sf, "documents")).select(
        F.col("file_path").alias("path"), F.lit("markdown").alias("converter"), "text"
    )
    arrived = deliveries(spark, f"{sf}/documents.parquet", 3)
    files.repartition(arrived).write.parquet(f"{base}/in")
    arriving = stream.file_stream(spark, f"{base}/in", files.schema, files_per_batch=arrived // 3)
    stream.append_index(arriving, CHUNKER, f"{base}/out", f"{base}/progress", embed=encode).awaitTermination()
    return spark.read.parquet(f"{base}/out").select(
        F.col("metadata")["file_path"].alias("file_path"), "chunk_index", "content",
        joined(F.transform("embedding", lambda x: x.cast("bigint"))).alias("counts"),
    )


@query(
    "k4_stream_answers",
    f"WITH {SQL_SCORED}, {SQL_CONTEXT} SELECT item_id AS query_id, prompt, citations FROM prompts",
)
def _(spark, sf):
    base = fresh_dir(spark, "stream")
    asked = table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("question"))
    asked.repartition(2).write.parquet(f"{base}/in")
    docs = with_paths(table(spark, sf, "documents")).select("doc_id", "text", "file_path", "commit")
    chunks = chunking.drop_blank(chunking.chunk(docs, CHUNKER))
    chunks.withColumn("embedding", encode(F.col("content"))).write.parquet(f"{base}/index")

    def answer(batch):
        index = batch.sparkSession.read.parquet(f"{base}/index")
        answered = jobs.answer_from_index(batch, index, encode, len(KEYWORDS), top_k=0, digits=6)
        return answered.withColumn("citations", answering.citation_report(F.col("citations")))

    arriving = stream.file_stream(spark, f"{base}/in", asked.schema, files_per_batch=1)
    stream.answer_stream(arriving, answer, f"{base}/out", f"{base}/progress").awaitTermination()
    return spark.read.parquet(f"{base}/out").select("query_id", "prompt", "citations")
