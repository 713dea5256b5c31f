"""Spans of regular expressions as DataFrame expressions, and the same in SQL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

FOUND = "array<struct<start:int,end:int,value:string>>"
_BLOCK = 256


def find_all(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as ``array<struct<start, end, value>>``.

    Offsets are code points, ends exclusive. The matches and the gaps between them
    come from two scans; their lengths add up to the offsets in one pass, in blocks,
    so that a text with very many matches stays linear.
    """
    parts = F.zip_with(
        F.split(text, pattern, -1),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda gap, value: F.struct(F.length(gap).alias("gap"), value.alias("value")),
    )
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(FOUND).alias("block"), F.array().cast(f"array<{FOUND}>").alias("blocks"))

    def step(done: Column, part: Column) -> Column:
        start = done["at"] + part["gap"]
        end = start + F.length(part["value"])
        one = F.array(F.struct(start.alias("start"), end.alias("end"), part["value"].alias("value")))
        full = F.size(done["block"]) >= _BLOCK
        moved = F.struct(
            end.alias("at"),
            F.when(full, one).otherwise(F.concat(done["block"], one)).alias("block"),
            F.when(full, F.concat(done["blocks"], F.array(done["block"]))).otherwise(done["blocks"]).alias("blocks"),
        )
        return F.when(part["value"].isNull(), done).otherwise(moved)

    found = F.aggregate(parts, zero, step, lambda done: F.concat(F.flatten(done["blocks"]), done["block"]))
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(FOUND))


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def joined(spans: Column) -> Column:
    """``kind:start:end`` of sorted spans, parted by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def sql_find(source: str, kind: str, rank: int, pattern: str, keep: str) -> str:
    """SELECT of ``doc_id, kind, rank, s, e, value, text`` from ``source(doc_id, text)``, 0-based, end exclusive.

    ``keep`` is a condition on these columns.
    """
    quoted = pattern.replace("'", "''")
    return f"""
  SELECT doc_id, '{kind}' AS kind, {rank} AS rank, s, e FROM (
    SELECT doc_id, text, value, gaps_before + values_before AS s, gaps_before + values_before + length(value) AS e FROM (
      SELECT doc_id, text, value,
        sum(length(gap)) OVER w AS gaps_before, sum(length(value)) OVER w - length(value) AS values_before
      FROM (
        SELECT doc_id, text, unnest(vals) AS value, unnest(gaps[:len(vals)]) AS gap, generate_subscripts(vals, 1) AS i FROM (
          SELECT doc_id, text, regexp_extract_all(text, '{quoted}') AS vals, string_split_regex(text, '{quoted}') AS gaps
          FROM {source}) WHERE len(vals) > 0)
      WINDOW w AS (PARTITION BY doc_id ORDER BY i))) WHERE {keep}"""


def sql_report(source: str, finds: Sequence[str], base: Sequence[str]) -> str:
    """The contract's columns from the span queries of all kinds."""
    names = ", ".join(f"'{kind}'" for kind in base)
    counts = ", ".join(f"count(*) FILTER (kind = '{kind}') AS n_{kind}" for kind in base)
    shown = "kind || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT), ',' ORDER BY s, rank"
    columns = ", ".join(f"coalesce(n_{kind}, 0) AS n_{kind}" for kind in base)
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM {source}),
found AS ({" UNION ALL ".join(finds)}),
summed AS (
  SELECT doc_id, {counts}, string_agg({shown}) FILTER (kind IN ({names})) AS base, string_agg({shown}) AS spans
  FROM found GROUP BY doc_id)
SELECT doc_id, {columns}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN summed USING (doc_id)"""
