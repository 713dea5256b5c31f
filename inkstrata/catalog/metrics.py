"""Queries: metrics over tables."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkstrata.catalog.base import SQL_PAIRS, SQL_WORDS, query, sql_strip, table
from inkstrata.catalog.ingest import vectors
from inkstrata.functions import vectors as vx
from inkstrata.operators import evaluation, examples, sinks
from inkstrata.plans import jobs
from inkstrata.session import fresh_dir
from inkstrata.sources import files


def predictions(spark, sf):
    """Padded answers with changed case; every fourth conversation has no reference."""
    pairs = examples.instruction_pairs(table(spark, sf, "conversations"))
    changed = F.when(F.col("turn") % 4 == 2, F.concat("response", F.lit("!"))).otherwise(
        F.replace("response", F.lit("e"), F.lit("E"))
    )
    return pairs.select("conv_id", "turn", F.concat(F.lit("  "), changed, F.lit(" ")).alias("prediction"))


def references(spark, sf):
    pairs = examples.instruction_pairs(table(spark, sf, "conversations"))
    return pairs.select(
        "conv_id",
        "turn",
        F.when(F.col("conv_id") % 4 == 0, F.array().cast("array<string>"))
        .otherwise(F.array("prompt", "response"))
        .alias("references"),
    )


SQL_PREDICTIONS = f"""
{SQL_PAIRS},
preds AS (SELECT conv_id, turn, '  ' || CASE WHEN turn % 4 = 2 THEN response || '!' ELSE replace(response, 'e', 'E') END || ' '
  AS prediction FROM pairs),
refs AS (SELECT conv_id, turn, CASE WHEN conv_id % 4 = 0 THEN [] ELSE [prompt, response] END AS refs FROM pairs),
scored AS (SELECT conv_id, turn, list_contains(list_transform(refs, lambda r: lower({sql_strip('r')})),
  lower({sql_strip('prediction')})) AS hit, len(refs) AS n_refs FROM preds JOIN refs USING (conv_id, turn))"""


@query(
    "e5_predictions_with_references",
    f"WITH {SQL_PREDICTIONS} SELECT conv_id, turn, CAST(n_refs AS INTEGER) AS n_references, prediction "
    "FROM scored JOIN preds USING (conv_id, turn)",
)
def _(spark, sf):
    both = predictions(spark, sf).join(references(spark, sf), ["conv_id", "turn"])
    return both.select("conv_id", "turn", F.size("references").alias("n_references"), "prediction")


@query("f2_exact_match", f"WITH {SQL_PREDICTIONS} SELECT round(avg(CAST(hit AS INTEGER)), 9) AS exact_match FROM scored")
def _(spark, sf):
    both = predictions(spark, sf).join(references(spark, sf), ["conv_id", "turn"])
    return evaluation.exact_match(both).select(F.round("exact_match", 9).alias("exact_match"))


def copy_context(prompt: str) -> str:
    """A caller's generator: echoes the prompt and answers with the context, now and then wrongly."""
    context = prompt.split("\nContext: ", 1)[1].removesuffix("\nAnswer:")
    return prompt + "  " + context.replace("e", "E") + ("! " if len(context) % 3 == 0 else " ")


@query(
    "n6_doc_qa_report",
    f"""WITH {SQL_PAIRS}, scored AS (SELECT list_contains(
        CASE WHEN conv_id % 4 = 0 THEN [] ELSE [lower({sql_strip('prompt')}), lower({sql_strip('response')})] END,
        lower({sql_strip("replace(response, 'e', 'E') || CASE WHEN length(response) % 3 = 0 THEN '!' ELSE '' END")})) AS hit
      FROM pairs)
    SELECT round(avg(CAST(hit AS INTEGER)), 9) AS exact_match FROM scored""",
)
def _(spark, sf):
    path = fresh_dir(spark, "qa")
    pairs = examples.instruction_pairs(table(spark, sf, "conversations"))
    sinks.write_json(
        pairs.select(
            F.col("prompt").alias("question"), F.col("response").alias("context"),
            F.when(F.col("conv_id") % 4 != 0, F.array("prompt", "response")).alias("answers"),
        ),
        path,
    )
    report = jobs.qa_report(files.read_qa(spark, path), copy_context)
    return report.select(F.round("exact_match", 9).alias("exact_match"))


SQL_RESULTS = """
results AS (SELECT source AS task_id, doc_id, quality = 1 AS passed FROM documents JOIN labels USING (doc_id)),
tasks AS (SELECT DISTINCT source AS task_id FROM documents)"""


def results(spark, sf):
    """Labelled documents as samples, their source as the task."""
    docs = table(spark, sf, "documents").select("doc_id", F.col("source").alias("task_id"))
    labels = table(spark, sf, "labels").select("doc_id", (F.col("quality") == 1).alias("passed"))
    return docs.join(labels, "doc_id")


def tasks(spark, sf):
    return table(spark, sf, "documents").select(F.col("source").alias("task_id")).distinct()


def problems(spark, sf):
    return table(spark, sf, "documents").groupBy(F.col("source").alias("task_id")).agg(
        F.min_by("lang", "doc_id").alias("prompt"), F.count(F.lit(1)).alias("size")
    )


@query(
    "e4_samples_with_problems",
    f"""WITH {SQL_RESULTS}, problems AS (
      SELECT source AS task_id, arg_min(lang, doc_id) AS prompt, count(*) AS size FROM documents GROUP BY source)
    SELECT task_id, doc_id, CAST(passed AS INTEGER) AS passed, prompt, size FROM results JOIN problems USING (task_id)""",
)
def _(spark, sf):
    return evaluation.join_problems(results(spark, sf), problems(spark, sf), ["doc_id"]).select(
        "task_id", "doc_id", F.col("passed").cast("int").alias("passed"), "prompt", "size"
    )


@query(
    "e4_unattempted_problems",
    """SELECT doc_id AS task_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
)
def _(spark, sf):
    every = table(spark, sf, "documents").select(F.col("doc_id").alias("task_id"))
    return evaluation.unattempted(every, table(spark, sf, "labels").select(F.col("doc_id").alias("task_id")))


SQL_PASS = f"""
{SQL_RESULTS},
counts AS (SELECT task_id, count(*) AS n, count(*) FILTER (WHERE passed) AS c FROM results GROUP BY task_id)"""


def sql_pass(k: int) -> str:
    estimate = (
        f"CASE WHEN c = 0 THEN 0.0 WHEN n - c < {k} THEN 1.0 ELSE 1.0 - "
        f"list_product(list_transform(range(n - c + 1, n + 1), lambda i: 1.0 - {k} / CAST(i AS DOUBLE))) END"
    )
    return f"CASE WHEN min(n) >= {k} THEN round(avg({estimate}), 6) END AS pass_at_{k}"


@query("f5_pass_at_k", f"WITH {SQL_PASS} SELECT {sql_pass(1)}, {sql_pass(5)} FROM counts")
def _(spark, sf):
    report = evaluation.pass_at_k(results(spark, sf))
    return report.select(*[F.round(c, 6).alias(c) for c in report.columns])


@query(
    "f6_accuracy",
    """WITH tests AS (SELECT doc_id AS task_id, (quality = 1 OR k = 0) AS passed FROM labels, (VALUES (0), (1)) t(k)),
    by_task AS (SELECT task_id, bool_and(passed) AS passed FROM tests GROUP BY task_id)
    SELECT count(*) AS tasks, count(*) FILTER (WHERE coalesce(passed, true)) AS passed,
      round(avg(CAST(coalesce(passed, true) AS INTEGER)), 9) AS accuracy
    FROM documents LEFT JOIN by_task ON task_id = doc_id""",
)
def _(spark, sf):
    every = table(spark, sf, "documents").select(F.col("doc_id").alias("task_id"))
    tests = table(spark, sf, "labels").select(
        F.col("doc_id").alias("task_id"),
        F.explode(F.array(F.lit(True), F.col("quality") == 1)).alias("passed"),
    )
    return evaluation.accuracy(every, tests).withColumn("accuracy", F.round("accuracy", 9))


@query(
    "f3_perplexity",
    """SELECT round(exp(sum(ln(1 + value) / 10 * n) / greatest(1, sum(n))), 6) AS perplexity
    FROM (SELECT value, event_id % 7 + 1 AS n FROM events)""",
)
def _(spark, sf):
    losses = table(spark, sf, "events").select(
        (F.log(1 + F.col("value")) / 10).alias("loss"), (F.col("event_id") % 7 + 1).alias("n")
    )
    return evaluation.perplexity(losses).select(F.round("perplexity", 6).alias("perplexity"))


def sql_losses(max_length: int | None, texts: str = "(SELECT doc_id AS key, text FROM documents)") -> str:
    """``scored``: loss and words of each text under the bigrams of ``documents``."""
    cut = "" if max_length is None else f"WHERE pos <= {max_length}"
    return f"""
words AS (SELECT doc_id, unnest({SQL_WORDS}) AS w, generate_subscripts({SQL_WORDS}, 1) AS pos FROM documents),
follow AS (SELECT doc_id, pos, w AS w1, lead(w) OVER (PARTITION BY doc_id ORDER BY pos) AS w2 FROM words),
pair_counts AS (SELECT w1, w2, count(*) AS n FROM follow WHERE w2 IS NOT NULL GROUP BY w1, w2),
history AS (SELECT w1, sum(n) AS h FROM pair_counts GROUP BY w1),
given AS (SELECT key, unnest({SQL_WORDS}) AS w, generate_subscripts({SQL_WORDS}, 1) AS pos FROM {texts}),
seen AS (SELECT key, w AS w1, lead(w) OVER (PARTITION BY key ORDER BY pos) AS w2 FROM given {cut}),
losses AS (
  SELECT key, -avg(ln((coalesce(n, 0) + 1.0) / (coalesce(h, 0) + (SELECT count(DISTINCT w) FROM words)))) AS loss
  FROM seen LEFT JOIN pair_counts USING (w1, w2) LEFT JOIN history USING (w1) WHERE w2 IS NOT NULL GROUP BY key),
lengths AS (SELECT key, count(*) AS n FROM (SELECT * FROM given {cut}) GROUP BY key),
scored AS (SELECT d.key, loss, coalesce(n, 0) AS n FROM {texts} d LEFT JOIN losses USING (key)
  LEFT JOIN lengths USING (key))"""


def shown_losses(losses: DataFrame, key: str) -> DataFrame:
    return losses.select(
        key, F.round(F.coalesce("loss", F.lit(-1.0)), 6).alias("loss"), F.col("n").cast("bigint").alias("n")
    )


@query(
    "f4_bigram_losses",
    f"WITH {sql_losses(None)} SELECT key AS doc_id, round(coalesce(loss, -1), 6) AS loss, n FROM scored",
)
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return shown_losses(evaluation.bigram_loss(docs, evaluation.learn_bigrams(docs), "doc_id"), "doc_id")


SQL_HELD_OUT = """(SELECT 'b' || item_id AS key, text FROM benchmark
  UNION ALL SELECT 'c' || conv_id || '-' || turn, text FROM conversations)"""


@query(
    "f4_held_out_losses",
    f"WITH {sql_losses(None, SQL_HELD_OUT)} SELECT key, round(coalesce(loss, -1), 6) AS loss, n FROM scored",
)
def _(spark, sf):
    items = table(spark, sf, "benchmark").select(F.concat(F.lit("b"), "item_id").alias("key"), "text")
    turns = table(spark, sf, "conversations").select(F.concat(F.lit("c"), "conv_id", F.lit("-"), "turn").alias("key"), "text")
    model = evaluation.learn_bigrams(table(spark, sf, "documents"))
    return shown_losses(evaluation.bigram_loss(items.unionByName(turns), model, "key"), "key")


SQL_PERPLEXITY = "round(exp(sum(loss * n) / greatest(1, sum(CASE WHEN loss IS NOT NULL THEN n END))), 4) AS perplexity"


@query("n7_perplexity_whole_corpus", f"WITH {sql_losses(None)} SELECT {SQL_PERPLEXITY} FROM scored")
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    report = jobs.perplexity_report(docs, "doc_id", ["doc_id"], max_samples=None, max_length=None)
    return report.select(F.round("perplexity", 4).alias("perplexity"))


@query(
    "n7_perplexity_report",
    f"""WITH {sql_losses(1024)} SELECT {SQL_PERPLEXITY} FROM
    (SELECT s.* FROM scored s JOIN documents d ON d.doc_id = s.key WHERE d.text <> '' ORDER BY doc_id LIMIT 128)""",
)
def _(spark, sf):
    path = fresh_dir(spark, "metrics")
    docs = table(spark, sf, "documents").select("doc_id", "text").where("text <> ''")
    report = jobs.perplexity_report(docs, "doc_id", ["doc_id"])
    sinks.write_json(report, path)
    return spark.read.schema("perplexity double").json(path).select(F.round("perplexity", 4).alias("perplexity"))


@query(
    "b3_metrics_json",
    "SELECT count(*) AS texts, round(avg(length(text)), 6) AS mean_chars FROM documents",
)
def _(spark, sf):
    path = f"{fresh_dir(spark, 'metrics')}/runs/first"
    metrics = table(spark, sf, "documents").agg(
        F.count(F.lit(1)).alias("texts"), F.round(F.avg(F.length("text")), 6).alias("mean_chars")
    )
    sinks.write_json(metrics, path)
    return spark.read.schema("texts bigint, mean_chars double").json(path)


@query(
    "b5_samples_and_problems",
    """SELECT task_id, completion, prompt FROM
      (SELECT source AS task_id, text AS completion FROM documents)
      JOIN (SELECT source AS task_id, arg_min(lang, doc_id) AS prompt FROM documents GROUP BY source) USING (task_id)""",
)
def _(spark, sf):
    path = fresh_dir(spark, "code-eval")
    samples = table(spark, sf, "documents").select(
        "doc_id", F.col("source").alias("task_id"), F.col("text").alias("completion")
    )
    sinks.write_json(samples, f"{path}/samples")
    sinks.write_json(problems(spark, sf).select("task_id", "prompt"), f"{path}/problems")
    back = spark.read.schema("doc_id bigint, task_id string, completion string").json(f"{path}/samples")
    known = spark.read.schema("task_id string, prompt string").json(f"{path}/problems")
    return evaluation.join_problems(back, known, ["doc_id"]).select("task_id", "completion", "prompt")


@query(
    "d16_preference_scores",
    """WITH v AS (SELECT vec_id // 2 AS prompt_id, vec_id % 2 AS side, CAST(embedding AS DOUBLE[])[-1] AS last FROM embeddings)
    SELECT c.prompt_id, round(c.last, 6) AS chosen_score, round(r.last, 6) AS rejected_score
    FROM v c JOIN v r USING (prompt_id) WHERE c.side = 0 AND r.side = 1""",
)
def _(spark, sf):
    values = vectors(spark, sf).select(
        F.floor(F.col("vec_id") / 2).alias("prompt_id"),
        F.when(F.col("vec_id") % 2 == 0, "chosen").otherwise("rejected").alias("kind"),
        F.col("v").alias("values"),
    )
    return evaluation.preference_scores(values).select(
        "prompt_id", *[F.round(c, 6).alias(c) for c in ("chosen_score", "rejected_score")]
    )


SQL_ROLLOUTS = """
rollouts AS (SELECT vec_id, vec_id % 10 AS batch, CAST(embedding AS DOUBLE[])[1:8] AS logits, vec_id % 8 AS action,
  CAST(embedding AS DOUBLE[])[9] AS "value", CAST(label AS DOUBLE) AS reward FROM embeddings),
chosen AS (SELECT *, logits[action + 1] - list_max(logits)
  - ln(list_sum(list_transform(logits, lambda x: exp(x - list_max(logits))))) AS lp FROM rollouts)"""


def rollouts(spark, sf):
    return vectors(spark, sf).select(
        "vec_id",
        (F.col("vec_id") % 10).alias("batch"),
        F.slice("v", 1, 8).alias("logits"),
        (F.col("vec_id") % 8).alias("action"),
        F.col("v")[8].alias("value"),
        F.col("label").cast("double").alias("reward"),
        (F.col("vec_id") % 10 / 100).alias("kl"),
    )


@query("d17_chosen_log_probs", f"WITH {SQL_ROLLOUTS} SELECT vec_id, round(lp, 6) AS log_prob FROM chosen")
def _(spark, sf):
    log_prob = vx.chosen_log_prob(F.col("logits"), F.col("action"))
    return rollouts(spark, sf).select("vec_id", F.round(log_prob, 6).alias("log_prob"))


@query(
    "f7_policy_loss",
    f"""WITH {SQL_ROLLOUTS}, b AS (SELECT batch, -avg(lp * (reward - "value")) + max(batch / 100.0) AS loss FROM chosen GROUP BY batch)
    SELECT round(avg(loss), 6) AS loss FROM b""",
)
def _(spark, sf):
    return evaluation.policy_loss(rollouts(spark, sf)).select(F.round("loss", 6).alias("loss"))


@query("h2_first_samples", "SELECT doc_id, text FROM documents WHERE text <> '' ORDER BY doc_id LIMIT 128")
def _(spark, sf):
    return evaluation.take_first(table(spark, sf, "documents").where("text <> ''"), ["doc_id"], 128).select("doc_id", "text")


@query(
    "h3_file_order",
    """SELECT lang AS folder, CAST(row_number() OVER (ORDER BY lang) AS BIGINT) AS place, count(*) AS texts
    FROM documents WHERE text <> '' GROUP BY lang""",
)
def _(spark, sf):
    from pyspark.sql import Window

    root = fresh_dir(spark, "ordered")
    # a task writes a file of its own for each folder, so that no folder is one task's
    table(spark, sf, "documents").select("lang", "text").write.partitionBy("lang").parquet(root)
    folders = (
        files.read_eval_corpus(spark, root)
        .groupBy(F.regexp_extract("file_path", "lang=([^/]+)/", 1).alias("folder"))
        .agg(F.count(F.lit(1)).alias("texts"), F.min("file_path").alias("file_path"))
    )
    # one row per folder by now
    place = F.row_number().over(Window.orderBy("file_path")).cast("bigint")
    return folders.select("folder", place.alias("place"), "texts")


def by_length(batch: pd.DataFrame) -> pd.DataFrame:
    """A caller's scorer, as it would be handed to the library."""
    return pd.DataFrame({"doc_id": batch["doc_id"], "loss": batch["text"].str.len() / 1000.0, "n": 1})


@query("l4_user_scorer", "SELECT doc_id, round(length(text) / 1000.0, 6) AS loss FROM documents")
def _(spark, sf):
    scored = evaluation.score_rows(
        table(spark, sf, "documents").select("doc_id", "text"), by_length, "doc_id bigint, loss double, n bigint"
    )
    return scored.select("doc_id", F.round("loss", 6).alias("loss"))
