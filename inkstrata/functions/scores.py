"""Arithmetic behind metrics, schedules and progress logs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pass_at_k(n: Column, c: Column, k: int) -> Column:
    """Chance that one of ``k`` draws out of ``n`` samples, ``c`` correct, passes.

    One minus the chance of drawing ``k`` wrong samples in a row: ``k`` factors,
    however many samples a task has.
    """
    miss = F.lit(1.0)
    for j in range(k):
        miss = miss * (n - c - j) / (n - j)
    return F.when(n - c < k, F.lit(1.0)).otherwise(1.0 - miss)


def perplexity(loss: Column, weight: Column) -> Column:
    """Aggregate: exponential of the weighted mean loss."""
    total = F.sum(F.when(loss.isNotNull(), weight))
    return F.exp(F.coalesce(F.sum(loss * weight), F.lit(0.0)) / F.greatest(F.coalesce(total, F.lit(0)), F.lit(1)))


def mean_or_zero(total: Column, count: Column) -> Column:
    return total / F.greatest(count, F.lit(1))


def eta_seconds(avg_step: Column, step: Column, total_steps: Column) -> Column:
    return F.greatest(F.lit(0.0), avg_step * (total_steps - step - 1))


def tokens_per_second(tokens_per_step: Column, avg_step: Column) -> Column:
    return F.when(avg_step > 0, tokens_per_step / avg_step).otherwise(F.lit(0.0))


def warmup_then_decay(step: Column, warmup: int, total: Column) -> Column:
    """Linear rise over the warm-up steps, then linear fall to zero."""
    falling = (total - step) / F.greatest(F.lit(1), total - warmup)
    return F.when(step < warmup, (step + 1) / max(1, warmup)).otherwise(
        F.greatest(F.lit(0.0), falling)
    )
