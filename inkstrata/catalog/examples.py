"""Queries: token examples and batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkstrata.catalog.base import (
    SQL_PAIRS, SQL_VOCABULARY, joined, query, sql_encoded, table, vocabulary,
)
from inkstrata.functions import tokens as tk
from inkstrata.operators import examples
from inkstrata.operators import vocabulary as vb
from inkstrata.plans import jobs

# The reference's lengths.
SEQ, BATCH = 2048, 16
MAX_LENGTH, PAIR_BATCH = 1024, 8


@query("c12_instruction_records", f"WITH {SQL_PAIRS} SELECT conv_id, turn, text FROM pairs")
def _(spark, sf):
    return examples.instruction_pairs(table(spark, sf, "conversations")).select("conv_id", "turn", "text")


SQL_EXAMPLES = f"""
{SQL_VOCABULARY}, {sql_encoded('documents', 'doc_id')},
bodies AS (SELECT doc_id, list_concat([2], ids)[1:{SEQ}] AS ids FROM encoded),
example AS (SELECT doc_id, list_concat(ids, list_transform(range(0, {SEQ} - len(ids)), lambda x: 0)) AS input_ids FROM bodies)"""


def fixed(spark, sf):
    docs = table(spark, sf, "documents")
    encoded = vb.encode_words(docs, vocabulary(spark, sf), "doc_id", limit=SEQ - 1)
    return examples.fixed_examples(encoded, SEQ, vb.PAD, vb.BOS)


@query("d10_fixed_length", f"WITH {SQL_EXAMPLES} SELECT doc_id, array_to_string(input_ids, ' ') AS input_ids FROM example")
def _(spark, sf):
    return fixed(spark, sf).select("doc_id", joined("input_ids").alias("input_ids"))


SQL_MASK = "list_transform(input_ids, lambda x: CASE WHEN x <> 0 THEN 1 ELSE 0 END)"


@query("d11_attention_mask", f"WITH {SQL_EXAMPLES} SELECT doc_id, array_to_string({SQL_MASK}, ' ') AS attention_mask FROM example")
def _(spark, sf):
    return fixed(spark, sf).select("doc_id", joined("attention_mask").alias("attention_mask"))


@query(
    "d12_batches",
    f"""WITH b AS (SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // {BATCH} AS batch_id FROM documents)
    SELECT batch_id, count(*) AS batch_rows, string_agg(doc_id, ' ' ORDER BY doc_id) AS doc_ids FROM b GROUP BY batch_id""",
)
def _(spark, sf):
    batched = examples.assign_batches(table(spark, sf, "documents").select("doc_id"), BATCH, ["doc_id"])
    return examples.collect_batches(batched, "doc_id").select(
        "batch_id", F.col("batch_rows").cast("bigint").alias("batch_rows"), joined("doc_id").alias("doc_ids")
    )


SQL_PADDED = f"""
{SQL_VOCABULARY}, {SQL_PAIRS}, {sql_encoded('pairs', 'conv_id, turn')},
cut AS (SELECT conv_id, turn, ids[1:{MAX_LENGTH}] AS ids,
  (row_number() OVER (ORDER BY conv_id, turn) - 1) // {PAIR_BATCH} AS batch_id FROM encoded),
longest AS (SELECT *, max(len(ids)) OVER (PARTITION BY batch_id) AS longest FROM cut),
padded AS (SELECT conv_id, turn, batch_id,
  list_concat(ids, list_transform(range(0, longest - len(ids)), lambda x: 0)) AS input_ids FROM longest)"""


def padded(spark, sf):
    return jobs.instruction_examples(table(spark, sf, "conversations"), vocabulary(spark, sf), PAIR_BATCH, MAX_LENGTH)


@query(
    "d13_dynamic_padding",
    f"WITH {SQL_PADDED} SELECT conv_id, turn, batch_id, array_to_string(input_ids, ' ') AS input_ids FROM padded",
)
def _(spark, sf):
    return padded(spark, sf).select("conv_id", "turn", "batch_id", joined("input_ids").alias("input_ids"))


@query(
    "d14_next_token_targets",
    f"""WITH {SQL_EXAMPLES} SELECT doc_id, array_to_string(input_ids[:-2], ' ') AS inputs,
      array_to_string(input_ids[2:], ' ') AS labels,
      CAST(len(list_filter(input_ids[2:], lambda x: x <> 0)) AS INTEGER) AS counted_labels FROM example""",
)
def _(spark, sf):
    made = examples.with_targets(fixed(spark, sf), vb.PAD)
    return made.select("doc_id", joined("inputs").alias("inputs"), joined("labels").alias("labels"), "counted_labels")


@query(
    "d15_unshifted_targets",
    f"""WITH {SQL_PADDED} SELECT conv_id, turn, array_to_string(input_ids, ' ') AS labels,
      CAST(len(list_filter(input_ids, lambda x: x <> 0)) AS INTEGER) AS counted_labels FROM padded""",
)
def _(spark, sf):
    return padded(spark, sf).select("conv_id", "turn", joined("labels").alias("labels"), "counted_labels")


@query(
    "d18_tokens_per_step",
    f"""WITH b AS (SELECT (row_number() OVER (ORDER BY doc_id) - 1) // {BATCH} AS batch_id FROM documents)
    SELECT batch_id, count(*) * {SEQ} AS tokens FROM b GROUP BY batch_id""",
)
def _(spark, sf):
    batched = examples.assign_batches(table(spark, sf, "documents").select("doc_id"), BATCH, ["doc_id"])
    return batched.groupBy("batch_id").agg(
        examples.tokens_per_step(F.count(F.lit(1)), F.lit(SEQ)).alias("tokens")
    )


@query(
    "h4_stop_after_steps",
    f"""WITH b AS (SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // {BATCH} AS batch_id FROM documents)
    SELECT batch_id, count(*) AS texts FROM b WHERE batch_id <= 5 GROUP BY batch_id""",
)
def _(spark, sf):
    batched = examples.assign_batches(table(spark, sf, "documents").select("doc_id"), BATCH, ["doc_id"])
    return examples.limit_batches(batched, 5).groupBy("batch_id").agg(F.count(F.lit(1)).alias("texts"))


@query(
    "n4_training_examples",
    f"""WITH {SQL_EXAMPLES}, b AS (SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) AS r FROM documents WHERE text <> '')
    SELECT doc_id, r // {BATCH} AS batch_id, CAST(r % {BATCH} AS INTEGER) AS batch_pos,
      array_to_string(input_ids, ' ') AS input_ids, array_to_string({SQL_MASK}, ' ') AS attention_mask,
      array_to_string(input_ids[2:], ' ') AS labels FROM example JOIN b USING (doc_id)""",
)
def _(spark, sf):
    made = jobs.training_examples(table(spark, sf, "documents"), vocabulary(spark, sf), "doc_id", SEQ, BATCH)
    return made.select(
        "doc_id", "batch_id", "batch_pos", *[joined(c).alias(c) for c in ("input_ids", "attention_mask", "labels")]
    )


@query(
    "n5_instruction_examples",
    f"""WITH {SQL_PADDED} SELECT conv_id, turn, batch_id, array_to_string(input_ids, ' ') AS input_ids,
      array_to_string({SQL_MASK}, ' ') AS attention_mask FROM padded""",
)
def _(spark, sf):
    return padded(spark, sf).select(
        "conv_id", "turn", "batch_id", joined("input_ids").alias("input_ids"), joined("attention_mask").alias("attention_mask")
    )
