"""Consecutive row numbers and rolling frames without a one-task window.

A window over a whole table, or over one hot group, runs in a single task. Here
the order key is cut at its quantiles into buckets; rows are numbered inside
their bucket and moved up by the number of rows in earlier buckets. No task
sees more than about one bucket, whatever the groups look like.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EXACT_DOUBLE = 2.0**53
# Bytes of a name that make a whole number which a double holds exactly.
_NAME_BYTES = 6


def _as_number(df: DataFrame, name: str) -> Column | None:
    """Order key as a double, or None for types that have no such form."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.NumericType):
        return F.col(name).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(name).cast("timestamp")).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(F.col(name)).cast("double")
    return None


def _quantiles(df: DataFrame, key: Column, buckets: int) -> list[float]:
    probabilities = [i / buckets for i in range(1, buckets)]
    return df.select(key.alias("key")).approxQuantile("key", probabilities, 0.5 / buckets)


def _edges(quantiles: list[float]) -> tuple[list[float], list[float]]:
    """Cut points, and the values so frequent that they get a bucket of their own."""
    hot = sorted({a for a, b in zip(quantiles, quantiles[1:]) if a == b and abs(a) < _EXACT_DOUBLE})
    cuts = set(quantiles)
    cuts.update(math.nextafter(value, math.inf) for value in hot)
    return sorted(cuts), hot


def _bucket(df: DataFrame, key: Column, cuts: list[float], out: str) -> DataFrame:
    if not cuts:
        return df.withColumn(out, F.lit(0))
    splits = [-math.inf, *cuts, math.inf]
    keyed = df.withColumn("_key", key)
    placed = Bucketizer(splits=splits, inputCol="_key", outputCol=out).transform(keyed).drop("_key")
    # whole numbers, so that window, count and join share one partitioning
    return placed.withColumn(out, F.col(out).cast("int"))


def _shared_prefix(df: DataFrame, name: str) -> int:
    """How many leading bytes all values of a string column have in common."""
    least, most = df.agg(F.min(F.encode(name, "UTF-8")), F.max(F.encode(name, "UTF-8"))).first()
    if least is None:
        return 0
    same = 0
    while same < min(len(least), len(most)) and least[same] == most[same]:
        same += 1
    return same


def _name_part(name: str, start: int) -> Column:
    """Some bytes of a string from ``start`` on as a number, in the order of the strings."""
    part = F.hex(F.substring(F.encode(name, "UTF-8"), start + 1, _NAME_BYTES))
    return F.conv(F.rpad(part, 2 * _NAME_BYTES, "0"), 16, 10).cast("double")


def _with_buckets(df: DataFrame, order_by: Sequence[str], buckets: int) -> tuple[DataFrame, list[str]]:
    """Rows with the columns of their cell; cells sort as their rows do.

    The first key is cut at its quantiles. Where one of its values is so frequent
    that it fills a bucket, the rows of that value are cut by the next key, and so
    on. Strings are cut by the bytes after what all of them share, and by later
    bytes where these are frequent and the strings still differ.
    """
    out, levels = df, []
    open_: Column | None = None
    pending: list[tuple[str, int | None]] = [(name, None) for name in order_by]
    while pending:
        name, start = pending.pop(0)
        rows = out if open_ is None else out.where(open_)
        key, is_name = _as_number(out, name), False
        if key is None:
            if not isinstance(df.schema[name].dataType, T.StringType):
                break
            is_name, start = True, _shared_prefix(rows, name) if start is None else start
            key = _name_part(name, start)
        cuts, hot = _edges(_quantiles(rows, key, buckets))
        level = ("_bucket", "_inner")[len(levels)] if len(levels) < 2 else f"_inner{len(levels)}"
        out = _bucket(out, key, cuts, level)
        if open_ is not None:
            out = out.withColumn(level, F.when(open_, F.col(level)).otherwise(0))
        levels.append(level)
        if not hot:
            break
        frequent = key.isin(hot)
        if is_name:
            longer, padded = rows.where(frequent).agg(
                F.bool_or(F.octet_length(name) > start + _NAME_BYTES), F.bool_or(F.contains(F.col(name), F.lit("\0")))
            ).first()
            if padded:
                # names that end in zero bytes have no number of their own
                break
            if longer:
                # cut by later bytes before the next key
                pending.insert(0, (name, start + _NAME_BYTES))
        open_ = frequent if open_ is None else open_ & frequent
    return out, levels


def number_rows(
    df: DataFrame,
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    out: str = "row_number",
    start: int = 1,
    buckets: int | None = None,
) -> DataFrame:
    """Number the rows of each group in order: ``start``, ``start + 1``, …

    ``order_by`` must name columns of ``df`` without nulls that order its rows
    fully. ``df`` is read a few times (quantiles and counts need the key columns
    only), so it should be a scan or a materialised table. ``buckets`` defaults to
    twice the shuffle partitions; keys may be numbers, times, dates or strings.
    """
    if buckets is None:
        buckets = 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(1, buckets)
    groups = list(partition_by)
    bucketed, levels = _with_buckets(df, order_by, buckets)
    cell = groups + [c for c in levels if c not in groups]

    # one row per group and bucket: the running sum is over a small table
    earlier = Window.partitionBy(*groups).orderBy(*levels).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy(*cell)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*cell, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy(*cell).orderBy(*order_by)
    numbered = bucketed.withColumn("_local", F.row_number().over(inside))
    return numbered.join(offsets, cell).select(
        *[F.col(c) for c in df.columns],
        (F.col("_before") + F.col("_local") + (start - 1)).cast("bigint").alias(out),
    )


def rolling_mean(
    df: DataFrame,
    value: str,
    step: str,
    window: int,
    partition_by: Sequence[str] = (),
    out: str = "rolling_mean",
    block: int = 100_000,
) -> DataFrame:
    """Mean of ``value`` over the last ``window`` steps of a run, the current one included.

    ``step`` must count 0, 1, 2, … inside each run. A run is cut into blocks of
    steps; the last ``window - 1`` rows of a block are handed to the next block
    as well, so that every frame is complete and no run is held by one task.
    """
    if window < 1:
        raise ValueError("window must be >= 1")
    block = max(block, window)
    home = F.floor(F.col(step) / block)
    lent = F.col(step) % block >= block - (window - 1)
    blocks = F.when(lent, F.array(home, home + 1)).otherwise(F.array(home))
    spread = df.withColumn("_home", home).withColumn("_block", F.explode(blocks))
    frame = (
        Window.partitionBy(*partition_by, "_block").orderBy(step).rowsBetween(-(window - 1), 0)
    )
    return (
        spread.withColumn(out, F.avg(value).over(frame))
        .where(F.col("_home") == F.col("_block"))
        .drop("_home", "_block")
    )
