"""Token examples: fixed-length rows, batches, targets, instruction pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkstrata.functions import text as tx
from inkstrata.functions import tokens as tk
from inkstrata.operators.numbering import number_rows


def fixed_examples(encoded: DataFrame, seq_length: int, pad: int, bos: int) -> DataFrame:
    """Replaces ``ids`` by ``input_ids`` and ``attention_mask`` of ``seq_length`` entries."""
    return encoded.withColumn("input_ids", tk.fixed_length(F.col("ids"), seq_length, bos, pad)).withColumn(
        "attention_mask", tk.attention_mask(F.col("input_ids"), pad)
    ).drop("ids")


def assign_batches(rows: DataFrame, batch_size: int, order_by: Sequence[str]) -> DataFrame:
    """Adds ``batch_id`` and ``batch_pos``, both from zero, in the given order."""
    numbered = number_rows(rows, order_by, out="_row", start=0)
    return (
        numbered.withColumn("batch_id", F.floor(F.col("_row") / batch_size).cast("bigint"))
        .withColumn("batch_pos", (F.col("_row") % batch_size).cast("int"))
        .drop("_row")
    )


def collect_batches(batched: DataFrame, *columns: str) -> DataFrame:
    """One row per batch with its columns as lists in order; a list is one batch long."""
    gathered = batched.groupBy("batch_id").agg(
        F.sort_array(F.collect_list(F.struct("batch_pos", *columns))).alias("_rows")
    )
    return gathered.select(
        "batch_id",
        F.size("_rows").alias("batch_rows"),
        *[F.col("_rows")[c].alias(c) for c in columns],
    )


def dynamic_padding(batched: DataFrame, max_length: int, pad: int = 0) -> DataFrame:
    """Cut ``ids`` to ``max_length`` and pad to the longest row of the batch."""
    cut = batched.withColumn("ids", F.slice("ids", 1, max_length))
    longest = F.max(F.size("ids")).over(Window.partitionBy("batch_id"))
    return (
        cut.withColumn("_longest", longest)
        .withColumn("input_ids", tk.pad_to(F.col("ids"), F.col("_longest"), pad))
        .withColumn("attention_mask", tk.attention_mask(F.col("input_ids"), pad))
        .drop("ids", "_longest")
    )


def with_targets(examples: DataFrame, pad: int, shifted: bool = True) -> DataFrame:
    """Model inputs and labels; instruction batches predict the ids as they stand."""
    ids = F.col("input_ids")
    inputs, labels = (tk.model_inputs(ids), tk.next_token_labels(ids)) if shifted else (ids, ids)
    return examples.withColumn("inputs", inputs).withColumn("labels", labels).withColumn(
        "counted_labels", tk.counted_labels(F.col("labels"), pad)
    )


def tokens_per_step(batch_size: Column, seq_length: Column) -> Column:
    return batch_size * seq_length


def instruction_pairs(turns: DataFrame) -> DataFrame:
    """Each user turn with the assistant turn right behind it.

    ``(conv_id, turn)`` is the join key, so one endless conversation is spread
    like any other rows.
    """
    asked = turns.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("prompt"))
    answered = turns.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("response")
    )
    return asked.join(answered, ["conv_id", "turn"]).withColumn(
        "text", tx.instruction_record(F.col("prompt"), F.col("response"))
    )


def limit_batches(batched: DataFrame, max_steps: int) -> DataFrame:
    """The batches that are run before the loop stops: the check follows the step."""
    return batched.where(F.col("batch_id") <= max_steps)
