"""Lookup joins that stay balanced when a few keys hold most of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkstrata.session import cut_lineage

MIN_HOT_KEYS = 256


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_limit(df: DataFrame) -> int:
    """How many keys are treated as hot: more than there are reduce tasks."""
    return max(MIN_HOT_KEYS, 2 * partitions(df))


def largest_keys(sizes: DataFrame, keys: Sequence[str], size: str) -> DataFrame:
    """``keys, _size`` of the most frequent keys of a table of key counts.

    Every key left out holds at most ``1 / limit`` of the rows, less than the
    fair share of a task, so it is enough to treat just these as hot.
    """
    return sizes.select(*keys, F.col(size).alias("_size")).orderBy(F.desc("_size"), *keys).limit(hot_limit(sizes))


def hot_keys(facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    return largest_keys(facts.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), keys, "_n")


def lookup_join(
    facts: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    row_id: Sequence[str],
    how: str = "inner",
    hot: DataFrame | None = None,
) -> DataFrame:
    """Join many ``facts`` to ``dim``, which is unique on ``keys``.

    The rows of a hot key are spread over sub-keys, as many as the key is times
    too large for one task, and the matching row of ``dim`` is copied once per
    sub-key: no more copies in all than twice the tasks and hot keys. ``row_id``
    are columns that tell the facts of a key apart. ``hot`` comes from
    :func:`largest_keys` where the caller has key counts already; otherwise the
    facts are counted. ``how`` is ``inner`` or ``left``.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    keys = list(keys)
    tasks = partitions(facts)
    # a bounded number of rows, settled once, as both sides must agree on them
    known = cut_lineage(hot_keys(facts, keys) if hot is None else hot)
    bounds = known.agg(F.sum("_size").alias("all"), F.min("_size").alias("least"), F.max("_size").alias("most"), F.count("_size").alias("n")).first()
    share = max(1.0, (bounds["all"] or 0) / tasks)
    if bounds["n"] >= hot_limit(facts):
        # some keys are left out, each of at most the least size
        share = max(share, float(bounds["least"]))
    row = F.xxhash64(*[F.col(c) for c in row_id])
    keyless = F.lit(False)
    for key in keys:
        keyless = keyless | F.col(key).isNull()
    if (bounds["most"] or 0) <= share:
        # no key is too large for a task, so nothing is broadcast
        if how == "inner":
            return facts.join(dim, keys)
        spread = facts.withColumn("_salt", F.when(keyless, F.pmod(row, F.lit(tasks))).otherwise(0).cast("int"))
        return spread.join(dim.withColumn("_salt", F.lit(0)), [*keys, "_salt"], how).drop("_salt")
    marked = F.broadcast(known.select(*keys, F.greatest(F.ceil(F.col("_size") / F.lit(share)).cast("int"), F.lit(1)).alias("_salts")))

    # facts without a key match nothing and may be just as many
    salts = F.when(keyless, F.lit(tasks)).otherwise(F.coalesce("_salts", F.lit(1)))
    left = facts.join(marked, keys, "left").withColumn("_salt", F.pmod(row, salts).cast("int")).drop("_salts")
    right = dim.join(marked, keys, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    ).drop("_salts")
    return left.join(right, [*keys, "_salt"], how).drop("_salt")
