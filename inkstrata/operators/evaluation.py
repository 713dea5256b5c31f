"""Metrics over prediction, result and score tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkstrata.functions import scores as sc
from inkstrata.functions import text as tx
from inkstrata.functions import vectors as vx
from inkstrata.operators.bigrams import BigramModel, bigram_loss, learn_bigrams  # noqa: F401
from inkstrata.operators.numbering import number_rows
from inkstrata.operators.skew import lookup_join
from inkstrata.session import materialize


def score_rows(
    df: DataFrame, scorer: Callable[[pd.DataFrame], pd.DataFrame], schema: str
) -> DataFrame:
    """A caller's scorer (loss, reward, pass or fail) over Arrow batches."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield scorer(batch)

    return df.mapInPandas(run, schema)


def exact_match(scored: DataFrame) -> DataFrame:
    """Share of ``prediction`` found among ``references``, both normalised."""
    found = F.array_contains(
        F.transform("references", tx.normalize_answer), tx.normalize_answer(F.col("prediction"))
    )
    return scored.agg(
        sc.mean_or_zero(
            F.coalesce(F.sum(found.cast("int")), F.lit(0)).cast("double"), F.count(F.lit(1))
        ).alias("exact_match")
    )


def attempts_by_task(samples: DataFrame) -> DataFrame:
    """``task_id, n, c``: samples and correct samples."""
    return samples.groupBy("task_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("passed").cast("int")).alias("c")
    )


def pass_at_k(samples: DataFrame, ks: Sequence[int] = (1, 5)) -> DataFrame:
    """Mean pass@k over the tasks; null unless every task has k samples."""
    tasks = attempts_by_task(samples)
    return tasks.agg(
        *[
            F.when(F.min("n") >= k, F.avg(F.when(F.col("n") >= k, sc.pass_at_k(F.col("n"), F.col("c"), k)))).alias(
                f"pass_at_{k}"
            )
            for k in ks
        ]
    )


def join_problems(samples: DataFrame, problems: DataFrame, row_id: Sequence[str]) -> DataFrame:
    """Samples with their problem; a task may have any number of samples."""
    return lookup_join(samples, problems, ["task_id"], row_id)


def unattempted(problems: DataFrame, samples: DataFrame) -> DataFrame:
    return problems.join(samples.select("task_id").distinct(), "task_id", "left_anti")


def accuracy(tasks: DataFrame, tests: DataFrame) -> DataFrame:
    """Share of tasks all of whose tests passed; a task without tests has passed."""
    by_task = tests.groupBy("task_id").agg(F.bool_and("passed").alias("passed"))
    return tasks.join(by_task, "task_id", "left").agg(
        F.count(F.lit(1)).alias("tasks"),
        F.sum(F.coalesce("passed", F.lit(True)).cast("int")).alias("passed"),
        F.avg(F.coalesce("passed", F.lit(True)).cast("double")).alias("accuracy"),
    )


def take_first(texts: DataFrame, order_by: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows in file order; a partial top-n per task, no full sort."""
    return texts.orderBy(*order_by).limit(n)


# Pairs of the corpus that a broadcast table may hold, and how long one of them may be.
PAIR_BYTES = 64


def _split_by_frequency(model: BigramModel, limit: int) -> tuple[DataFrame | None, DataFrame | None]:
    """``w1, w2, lp`` of the most frequent pairs, at most ``limit``, and the other pairs.

    The number of occurrences is cut at a step of a coarse histogram, so the first table
    is bounded without sorting the pairs; pairs of long words are among the others. None
    stands for an empty table. The first is empty, too, where it has less than half of
    all occurrences: the others are shuffled twice, so that it would not pay.
    """
    step = F.floor(4 * F.log2("n"))
    short = F.octet_length("w1") + F.octet_length("w2") <= PAIR_BYTES
    counts = model.pairs.groupBy(step.alias("step"), short.alias("short")).agg(F.count(F.lit(1)).alias("pairs"), F.sum("n").alias("times")).collect()
    steps = sorted(((r["step"], r["pairs"], r["times"]) for r in counts if r["short"]), reverse=True)
    room, lowest, covered = limit, None, 0
    for at, number, times in steps:
        if number > room:
            break
        room, lowest, covered = room - number, at, covered + times
    if lowest is None or 2 * covered < sum(r["times"] for r in counts):
        return None, model.pairs if counts else None
    chosen = short & (step >= lowest)
    all_chosen = len(steps) == len(counts) and lowest == steps[-1][0]
    own = model.history.select("w1", "h").join(F.broadcast(model.pairs.where(chosen)), "w1")
    held = materialize(own.select("w1", "w2", model.log_prob(F.col("n"), F.col("h")).alias("lp")), "frequent-pairs")
    return held, None if all_chosen else model.pairs.where(~chosen)


def perplexity(losses: DataFrame) -> DataFrame:
    return losses.agg(sc.perplexity(F.col("loss"), F.col("n")).alias("perplexity"))


def policy_loss(rollouts: DataFrame) -> DataFrame:
    """Mean loss over the batches of a rollout table.

    Rows have ``batch, logits, action, reward, value`` and maybe ``kl``; every
    epoch sees the same table, so their mean is the mean of one.
    """
    kl = F.col("kl") if "kl" in rollouts.columns else F.lit(0.0)
    advantage = F.col("reward") - F.col("value")
    chosen = vx.chosen_log_prob(F.col("logits"), F.col("action"))
    by_batch = rollouts.groupBy("batch").agg(
        (-F.avg(chosen * advantage) + F.coalesce(F.max(kl), F.lit(0.0))).alias("loss")
    )
    return by_batch.agg(sc.mean_or_zero(F.sum("loss"), F.count(F.lit(1))).alias("loss"))


def preference_scores(values: DataFrame, pair: Sequence[str] = ()) -> DataFrame:
    """Chosen and rejected score of every pair from ``prompt_id, kind, values``.

    A pair is a ``prompt_id`` that has both kinds, whether or not their scores are null.
    Where prompts have several pairs, ``pair`` names the columns that tell these apart;
    a kind that is there twice in a pair is an error.
    """

    def side(kind: str) -> list[Column]:
        of_kind = F.col("kind") == kind
        score = F.max(F.when(of_kind, vx.last_value(F.col("values"))))
        return [score.alias(f"{kind}_score"), F.count_if(of_kind).alias(f"_{kind}")]

    rows = values.groupBy("prompt_id", *pair).agg(*side("chosen"), *side("rejected"))
    repeated = F.raise_error(F.lit("a pair has several rows of one kind; name the columns of a pair")).cast("boolean")
    once = F.greatest("_chosen", "_rejected") < 2
    both = (F.col("_chosen") > 0) & (F.col("_rejected") > 0)
    return rows.where(F.when(once, both).otherwise(repeated)).drop("_chosen", "_rejected")


def positional_zip(
    left: DataFrame, right: DataFrame, left_order: Sequence[str], right_order: Sequence[str]
) -> DataFrame:
    """Rows of two tables paired by their place; the longer one loses its end."""
    return (
        number_rows(left, left_order, out="_place")
        .join(number_rows(right, right_order, out="_place"), "_place")
        .drop("_place")
    )
