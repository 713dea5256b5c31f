"""Step logs and version manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkstrata.functions import scores as sc
from inkstrata.operators.numbering import rolling_mean
from inkstrata.operators.skew import lookup_join

WINDOW_STEPS = 25


def progress(
    steps: DataFrame, total_steps: Column, tokens_per_step: int, window: int = WINDOW_STEPS, run: str = "run"
) -> DataFrame:
    """Adds the rolling step time, the time left and the token rate."""
    timed = rolling_mean(steps, "step_time", "step", window, (run,), "avg_step")
    return timed.withColumn(
        "eta_seconds", sc.eta_seconds(F.col("avg_step"), F.col("step"), total_steps)
    ).withColumn("tokens_per_second", sc.tokens_per_second(F.lit(float(tokens_per_step)), F.col("avg_step")))


def logged_steps(steps: DataFrame, every: int) -> DataFrame:
    return steps.where(F.col("step") % every == 0)


def saved_steps(steps: DataFrame, every: int) -> DataFrame:
    return steps.where((F.col("step") + 1) % every == 0)


def rotate_versions(manifest: DataFrame, keep: int, group: str = "run") -> DataFrame:
    """Adds ``kept``: is a version among the newest ``keep`` of its group?

    Versions are named ``step-<number>`` and compared by number; other names are
    always kept. Only the newest few of a group reach the window, and the rest
    is compared with the oldest of those.
    """
    number = F.when(
        F.col("name").startswith("step-"), F.element_at(F.split("name", "-"), -1).cast("bigint")
    )
    numbered = manifest.withColumn("_step", number)
    newest = (
        numbered.where(F.col("_step").isNotNull())
        .select(group, "_step")
        .withColumn("_r", F.row_number().over(Window.partitionBy(group).orderBy(F.desc("_step"))))
        .where(F.col("_r") <= keep)
        .groupBy(group)
        .agg(F.min("_step").alias("_oldest"))
    )
    flagged = lookup_join(numbered, newest, [group], ["name"], how="left")
    return flagged.withColumn(
        "kept", F.col("_step").isNull() | F.coalesce(F.col("_step") >= F.col("_oldest"), F.lit(False))
    ).drop("_step", "_oldest")
