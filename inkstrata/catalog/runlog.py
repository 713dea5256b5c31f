"""Queries: step logs and schedules."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkstrata.catalog.base import SQL_STEPS, query, step_log
from inkstrata.functions import scores as sc
from inkstrata.operators import runlog
from inkstrata.operators.numbering import rolling_mean
from inkstrata.session import materialize

SQL_ROLLING = f"""
{SQL_STEPS},
rolled AS (SELECT *, avg(step_time) OVER (PARTITION BY run ORDER BY step ROWS BETWEEN 24 PRECEDING AND CURRENT ROW)
  AS avg_step FROM steps)"""


@query("g1_rolling_step_time", f"WITH {SQL_ROLLING} SELECT run, step, round(avg_step, 6) AS avg_step FROM rolled")
def _(spark, sf):
    timed = rolling_mean(step_log(spark, sf), "step_time", "step", 25, ("run",), "avg_step", block=500)
    return timed.select("run", "step", F.round("avg_step", 6).alias("avg_step"))


@query(
    "g2_progress",
    f"""WITH {SQL_ROLLING} SELECT run, step, round(greatest(0, avg_step * (2000 - step - 1)), 4) AS eta_seconds,
      round(CASE WHEN avg_step > 0 THEN 2048 / avg_step ELSE 0 END, 6) AS tokens_per_second FROM rolled""",
)
def _(spark, sf):
    report = runlog.progress(step_log(spark, sf), F.lit(2000), 2048)
    return report.select(
        "run", "step", F.round("eta_seconds", 4).alias("eta_seconds"),
        F.round("tokens_per_second", 6).alias("tokens_per_second"),
    )


@query(
    "g3_logged_and_saved_steps",
    f"""WITH {SQL_STEPS} SELECT run, step, 'logged' AS kind FROM steps WHERE step % 10 = 0
    UNION ALL SELECT run, step, 'saved' FROM steps WHERE (step + 1) % 500 = 0""",
)
def _(spark, sf):
    steps = materialize(step_log(spark, sf).select("run", "step"), "steps")
    logged = runlog.logged_steps(steps, 10).withColumn("kind", F.lit("logged"))
    return logged.unionByName(runlog.saved_steps(steps, 500).withColumn("kind", F.lit("saved")))


@query(
    "g4_rotate_versions",
    f"""WITH {SQL_STEPS}, versions AS (SELECT run, step * 100 AS s FROM steps),
    ranked AS (SELECT run, s, row_number() OVER (PARTITION BY run ORDER BY s DESC) AS r FROM versions)
    SELECT run, 'step-' || s AS name, CASE WHEN r <= 3 THEN 1 ELSE 0 END AS kept FROM ranked
    UNION ALL SELECT DISTINCT run, 'final', 1 FROM steps""",
)
def _(spark, sf):
    steps = materialize(step_log(spark, sf), "steps")
    versions = steps.select("run", F.concat(F.lit("step-"), (F.col("step") * 100).cast("string")).alias("name"))
    final = steps.select("run").distinct().withColumn("name", F.lit("final"))
    rotated = runlog.rotate_versions(versions.unionByName(final), 3)
    return rotated.select("run", "name", F.col("kept").cast("int").alias("kept"))


@query(
    "g6_learning_rate_schedule",
    f"""WITH {SQL_STEPS} SELECT run, step, round(CASE WHEN step < 100 THEN (step + 1) / 100.0
      ELSE greatest(0, (1500 - step) / 1400.0) END, 9) AS factor FROM steps""",
)
def _(spark, sf):
    factor = sc.warmup_then_decay(F.col("step"), 100, F.lit(1500))
    return step_log(spark, sf).select("run", "step", F.round(factor, 9).alias("factor"))
