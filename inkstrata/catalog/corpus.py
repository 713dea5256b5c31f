"""Queries: scans, cleaning, shards (A, B, C, F8, I1, N1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkstrata.catalog.base import (
    SQL_BLOCKS, SQL_DIRTY, SQL_RECORDS, SQL_TAGGED, SQL_PAIRS, dirty, licensed, query, sql_normalized, sql_strip, table,
)
from inkstrata.functions import text as tx
from inkstrata.operators import cleaning, examples, sinks
from inkstrata.plans import jobs
from inkstrata.session import fresh_dir, materialize
from inkstrata.sources import files, specs

LAYOUT = "{root}/{name}.parquet"


@query("a1_dataset_spec_scan", "SELECT doc_id, text, 'documents__full' AS dataset, 'train' AS split FROM documents")
def _(spark, sf):
    spec = specs.DatasetSpec.parse("documents:full:train:text")
    return specs.read_dataset(spark, spec, sf, LAYOUT).select("doc_id", "text", "dataset", "split")


@query("a2_split_scan", "SELECT page_id, html AS text, 'train' AS split FROM pages")
def _(spark, sf):
    spec = specs.DatasetSpec.parse("pages:train:html")
    return specs.read_dataset(spark, spec, sf, LAYOUT).select("page_id", "text", "split")


@query(
    "a3_many_datasets",
    """SELECT 'documents' AS dataset, count(*) AS texts, CAST(sum(length(text)) AS BIGINT) AS chars FROM documents
    UNION ALL SELECT 'benchmark', count(*), CAST(sum(length(text)) AS BIGINT) FROM benchmark
    UNION ALL SELECT 'conversations', count(*), CAST(sum(length(text)) AS BIGINT) FROM conversations
    UNION ALL SELECT 'skipped absent:train:text', 0, 0
    UNION ALL SELECT 'skipped pages:train:text', 0, 0""",
)
def _(spark, sf):
    wanted = [f"{name}:train:text" for name in ("documents", "benchmark", "absent", "conversations", "pages")]
    texts, failed = specs.read_datasets(spark, wanted, sf, LAYOUT, skip_failed=True)
    return (
        texts.groupBy("dataset")
        .agg(F.count(F.lit(1)).alias("texts"), F.sum(F.length("text")).alias("chars"))
        .unionByName(
            failed.select(
                F.concat(F.lit("skipped "), "spec").alias("dataset"),
                F.lit(0).cast("bigint").alias("texts"),
                F.lit(0).cast("bigint").alias("chars"),
            )
        )
    )


SQL_LINES = f"""SELECT {sql_strip('line')} AS text FROM (
  SELECT unnest(string_split_regex(text, '\\r\\n?|\\n')) AS line FROM documents)
  WHERE length({sql_strip('line')}) > 0"""


@query("a4_text_lines", SQL_LINES)
def _(spark, sf):
    path = fresh_dir(spark, "lines")
    sinks.write_corpus(table(spark, sf, "documents"), path)
    return files.read_text_lines(spark, path).select("text")


@query("a5_jsonl_texts", "SELECT text FROM documents WHERE doc_id % 10 > 1 AND text <> ''")
def _(spark, sf):
    path = fresh_dir(spark, "jsonl")
    kind = F.col("doc_id") % 10
    holes = table(spark, sf, "documents").select(
        "doc_id", F.when(kind > 1, F.col("text")).when(kind == 1, F.lit("")).alias("text")
    )
    sinks.write_json(holes, path)
    return files.read_jsonl(spark, path).select("text")


@query("a6_parquet_texts", "SELECT text FROM documents WHERE text <> ''")
def _(spark, sf):
    return files.read_parquet_text(spark, f"{sf}/documents.parquet").select("text")


@query(
    "a7_recursive_corpus",
    f"""SELECT 'parquet' AS kind, text FROM conversations WHERE text <> ''
    UNION ALL SELECT 'txt', text FROM ({SQL_LINES})""",
)
def _(spark, sf):
    root = fresh_dir(spark, "corpus")
    sinks.write_corpus(table(spark, sf, "documents"), f"{root}/b/lines")
    table(spark, sf, "conversations").select("text").write.parquet(f"{root}/a/records")
    corpus = files.read_corpus(spark, [root])
    return corpus.select(F.regexp_extract("file_path", r"\.([a-z]+)$", 1).alias("kind"), "text")


@query(
    "a8_eval_corpus",
    "SELECT text FROM documents WHERE text <> '' UNION ALL SELECT text FROM benchmark WHERE text <> ''",
)
def _(spark, sf):
    root = fresh_dir(spark, "eval")
    for name in ("documents", "benchmark"):
        table(spark, sf, name).select("text").write.parquet(f"{root}/{name}")
    return files.read_eval_corpus(spark, root).select("text")


@query(
    "a9_question_set",
    f"""WITH {SQL_PAIRS}
    SELECT prompt AS question, response AS context,
      CASE WHEN conv_id % 4 = 0 THEN '' ELSE response || '|' || prompt END AS answers FROM pairs""",
)
def _(spark, sf):
    path = fresh_dir(spark, "qa")
    pairs = examples.instruction_pairs(table(spark, sf, "conversations"))
    sinks.write_json(
        pairs.select(
            F.col("prompt").alias("question"),
            F.col("response").alias("context"),
            F.when(F.col("conv_id") % 4 != 0, F.array("response", "prompt")).alias("answers"),
        ),
        path,
    )
    return files.read_qa(spark, path).withColumn("answers", F.array_join("answers", "|"))


@query(
    "a12_training_scan",
    """SELECT text FROM documents WHERE text <> '' UNION ALL SELECT text FROM benchmark WHERE text <> ''
    UNION ALL SELECT text FROM conversations WHERE text <> ''""",
)
def _(spark, sf):
    listed = [f"{sf}/{name}.parquet" for name in ("documents", "benchmark", "conversations")]
    return files.read_parquet_text(spark, listed).select("text")


@query(
    "a13_files_to_workers",
    """SELECT 0 AS position, 0 AS worker, text FROM documents WHERE text <> ''
    UNION ALL SELECT 1, 1, text FROM conversations WHERE text <> ''
    UNION ALL SELECT 2, 0, text FROM benchmark WHERE text <> ''""",
)
def _(spark, sf):
    listed = [f"{sf}/{name}.parquet" for name in ("documents", "conversations", "benchmark")]
    return files.read_for_workers(spark, listed, 2).select("position", "worker", "text")


@query(
    "b1_shard_assignment",
    f"""WITH {SQL_RECORDS}
    SELECT doc_id, lang AS split, (row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1) // 50 + 1 AS shard,
      CAST(length(text) AS INTEGER) AS num_chars FROM records""",
)
def _(spark, sf):
    records = cleaning.process_examples(licensed(spark, sf), keep=["doc_id", "lang"]).withColumnRenamed("lang", "split")
    # numbering passes read the narrow table, not the texts
    records = materialize(records.select("doc_id", "split", "num_chars"), "records")
    return sinks.assign_shards(records, ["doc_id"], 50, ("split",)).select("doc_id", "split", "shard", "num_chars")


@query(
    "b1_written_shards",
    """SELECT 'documents' AS dataset, lang AS split, count(*) AS records, CAST(sum(length(text)) AS BIGINT) AS chars,
      CAST(1 AS BIGINT) AS within_size
    FROM documents GROUP BY lang""",
)
def _(spark, sf):
    root = fresh_dir(spark, "shards")
    rows = table(spark, sf, "documents").select(F.lit("documents").alias("dataset"), F.col("lang").alias("split"), "text")
    sinks.write_shards(rows, root, 100)
    by_file = (
        spark.read.parquet(root)
        .groupBy("dataset", "split", F.col("_metadata.file_path").alias("file"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("c"))
    )
    return by_file.groupBy("dataset", "split").agg(
        F.sum("n").alias("records"),
        F.sum("c").alias("chars"),
        F.min((F.col("n") <= 100).cast("bigint")).alias("within_size"),
    )


@query(
    "b1_exact_shards",
    """SELECT 'documents' AS dataset, lang AS split, 'shard-' || lpad(CAST(shard AS VARCHAR), 5, '0') AS shard,
      CAST(1 AS BIGINT) AS files, count(*) AS records, min(doc_id) AS first_id, max(doc_id) AS last_id,
      CAST(sum(length(text)) AS BIGINT) AS chars
    FROM (SELECT doc_id, lang, text, (row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1) // 100 + 1 AS shard
      FROM documents) GROUP BY lang, shard""",
)
def _(spark, sf):
    root = fresh_dir(spark, "shards")
    rows = table(spark, sf, "documents").select("doc_id", F.lit("documents").alias("dataset"), F.col("lang").alias("split"), "text")
    sinks.write_exact_shards(sinks.assign_shards(materialize(rows, "records"), ["doc_id"], 100), root)
    return (
        spark.read.parquet(root)
        .groupBy("dataset", "split", "shard")
        .agg(
            F.countDistinct("_metadata.file_path").alias("files"),
            F.count(F.lit(1)).alias("records"),
            F.min("doc_id").alias("first_id"),
            F.max("doc_id").alias("last_id"),
            F.sum(F.length("text")).alias("chars"),
        )
    )


@query(
    "b4_tokenizer_corpus",
    """SELECT unnest(string_split(text, chr(10))) AS value FROM documents
    UNION ALL SELECT unnest(string_split(text, chr(10))) FROM benchmark""",
)
def _(spark, sf):
    both = table(spark, sf, "documents").select("text").unionByName(table(spark, sf, "benchmark").select("text"))
    path = fresh_dir(spark, "lines")
    sinks.write_corpus(both, path)
    return spark.read.option("lineSep", "\n").text(path)


@query("c1_tag_code_blocks", f"WITH {SQL_DIRTY} SELECT doc_id, {SQL_TAGGED} AS tagged FROM dirty")
def _(spark, sf):
    return dirty(spark, sf).select("doc_id", tx.tag_code_blocks(F.col("text")).alias("tagged"))


@query(
    "c2_extract_code_blocks",
    f"""WITH {SQL_DIRTY} SELECT doc_id, len({SQL_BLOCKS}) AS n_blocks,
    array_to_string({SQL_BLOCKS}, '|') AS blocks FROM dirty""",
)
def _(spark, sf):
    return (
        dirty(spark, sf)
        .select("doc_id", tx.code_blocks(F.col("text")).alias("b"))
        .select("doc_id", F.size("b").cast("bigint").alias("n_blocks"), F.array_join("b", "|").alias("blocks"))
    )


@query("c3_normalize_whitespace", f"WITH {SQL_DIRTY} SELECT doc_id, {sql_normalized('text')} AS text FROM dirty")
def _(spark, sf):
    return dirty(spark, sf).select("doc_id", tx.normalize_whitespace(F.col("text")).alias("text"))


SQL_PROCESSED = f"""WITH {SQL_RECORDS}
    SELECT doc_id, text, CAST(length(text) AS INTEGER) AS num_chars, CAST(len(blocks) AS INTEGER) AS num_code_blocks,
      CASE WHEN len(blocks) > 0 THEN array_to_string(blocks, E'\\n\\n') END AS code_blocks, license FROM records"""


@query("c4_process_examples", SQL_PROCESSED)
def _(spark, sf):
    return cleaning.process_examples(licensed(spark, sf), keep=["doc_id"])


@query(
    "c5_required_field",
    """SELECT 'documents' AS name, count(*) AS texts, '' AS error FROM documents
    UNION ALL SELECT 'benchmark', count(*), '' FROM benchmark
    UNION ALL SELECT 'pages', count(*), 'missing field ''text''; the columns are page_id, url, html' FROM pages""",
)
def _(spark, sf):
    def checked(name):
        rows = table(spark, sf, name)
        error = ""
        try:
            cleaning.require_field(rows, "text")
        except KeyError as problem:
            error = problem.args[0]
        return rows.agg(F.count(F.lit(1)).alias("texts")).select(
            F.lit(name).alias("name"), "texts", F.lit(error).alias("error")
        )

    return checked("documents").unionByName(checked("benchmark")).unionByName(checked("pages"))


@query(
    "c14_normalize_answers",
    f"SELECT conv_id, turn, lower({sql_strip('text')}) AS answer FROM "
    "(SELECT conv_id, turn, E' \\n' || replace(text, 'e', 'E') || chr(160) || chr(9) AS text FROM conversations)",
)
def _(spark, sf):
    padded = F.concat(F.lit(" \n"), F.replace("text", F.lit("e"), F.lit("E")), F.lit("\u00a0\t"))
    return table(spark, sf, "conversations").select("conv_id", "turn", tx.normalize_answer(padded).alias("answer"))


@query(
    "c15_test_lists",
    """SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'a' || event_id || '|b' WHEN 1 THEN 'not json ' || event_id ELSE '' END
      AS tests, CASE event_id % 3 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END AS n_tests FROM events""",
)
def _(spark, sf):
    kind, key = F.col("event_id") % 3, F.col("event_id").cast("string")
    raw = F.when(kind == 0, F.concat(F.lit('["a'), key, F.lit('","b"]'))).when(
        kind == 1, F.concat(F.lit("not json "), key)
    )
    return table(spark, sf, "events").select("event_id", tx.test_list(raw).alias("t")).select(
        "event_id", F.array_join("t", "|").alias("tests"), F.size("t").alias("n_tests")
    )


@query(
    "c16_candidate_programs",
    "SELECT doc_id, coalesce(CASE WHEN doc_id % 2 = 0 THEN source END, '') || chr(10) || text AS program FROM documents",
)
def _(spark, sf):
    code = F.when(F.col("doc_id") % 2 == 0, F.col("source"))
    return table(spark, sf, "documents").select(
        "doc_id", tx.candidate_program(code, F.col("text")).alias("program")
    )


@query(
    "c17_shard_directories",
    """SELECT directory, count(*) AS texts FROM (
      SELECT replace('web/' || source, '/', '_') || CASE WHEN lang <> 'en' THEN '__' || lang ELSE '' END AS directory
      FROM documents) GROUP BY directory""",
)
def _(spark, sf):
    config = F.when(F.col("lang") != "en", F.col("lang"))
    name = tx.shard_dir_name(F.concat(F.lit("web/"), "source"), config)
    return table(spark, sf, "documents").groupBy(name.alias("directory")).agg(F.count(F.lit(1)).alias("texts"))


@query(
    "f8_corpus_statistics",
    f"""WITH {SQL_RECORDS}
    SELECT coalesce(source, 'all') AS source, coalesce(lang, 'all') AS lang, count(*) AS records,
      CAST(sum(length(text)) AS BIGINT) AS num_chars, CAST(sum(len(blocks)) AS BIGINT) AS num_code_blocks, round(avg(length(text)), 6) AS avg_chars
    FROM records GROUP BY ROLLUP (source, lang)""",
)
def _(spark, sf):
    records = cleaning.process_examples(licensed(spark, sf), keep=["source", "lang"])
    return (
        cleaning.corpus_statistics(records, "source", "lang")
        .withColumn("source", F.coalesce("source", F.lit("all")))
        .withColumn("lang", F.coalesce("lang", F.lit("all")))
        .withColumn("avg_chars", F.round("avg_chars", 6))
    )


@query(
    "i1_concatenate_sources",
    "SELECT 'd' AS origin, text FROM documents UNION ALL SELECT 'b', text FROM benchmark UNION ALL SELECT 'd', text FROM documents",
)
def _(spark, sf):
    docs = table(spark, sf, "documents").select(F.lit("d").alias("origin"), "text")
    bench = table(spark, sf, "benchmark").select(F.lit("b").alias("origin"), "text")
    return docs.unionByName(bench).unionByName(docs)


@query(
    "n1_public_corpus",
    f"""WITH src AS (
      SELECT 'documents' AS dataset, doc_id AS id, text FROM documents
      UNION ALL SELECT 'benchmark', item_id, text FROM benchmark),
    cleaned AS (SELECT dataset, id, {sql_normalized(SQL_TAGGED)} AS text FROM src)
    SELECT dataset, 'train' AS split, id, text, CAST(length(text) AS INTEGER) AS num_chars,
      (row_number() OVER (PARTITION BY dataset ORDER BY id) - 1) // 300 + 1 AS shard FROM cleaned""",
)
def _(spark, sf):
    # both tables get a row key of one name, as shards are cut in key order
    root = fresh_dir(spark, "public")
    for name, key in (("documents", "doc_id"), ("benchmark", "item_id")):
        table(spark, sf, name).select(F.col(key).alias("id"), "text").write.parquet(f"{root}/{name}/train")
    sharded = jobs.public_corpus(
        spark, ["documents:train:text", "benchmark:train:text"], root, "{root}/{directory}/{split}", ["id"], 300
    )
    return sharded.select("dataset", "split", "id", "text", "num_chars", "shard")
