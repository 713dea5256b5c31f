"""Cleaning of raw examples and the record shape of the shards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkstrata.functions import text as tx


def require_field(df: DataFrame, field: str) -> None:
    """Fail before any job runs if the text field is not there."""
    if field not in df.columns:
        raise KeyError(f"missing field '{field}'; the columns are {', '.join(df.columns)}")


def process_examples(df: DataFrame, text_field: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Raw examples to cleaned records.

    The blocks are taken from the raw text, hence keep their indentation. Rows
    without text are dropped. ``keep`` names further columns to carry along.
    """
    require_field(df, text_field)
    raw = F.col(text_field).cast("string")
    license_column = (
        F.col("license").cast("string") if "license" in df.columns else F.lit(None).cast("string")
    )
    carried = [*(keep or []), "_blocks", "license"]

    # one step per projection, so that every intermediate text is made once
    def step(rows: DataFrame, change) -> DataFrame:
        return rows.select(*carried, change(F.col("text")).alias("text"))

    rows = df.where(raw.isNotNull()).select(
        *(keep or []), raw.alias("text"), tx.code_blocks(raw).alias("_blocks"), license_column.alias("license")
    )
    for change in (tx.tag_code_blocks, tx.newlines_only, tx.squeeze_blanks, tx.squeeze_newlines, tx.strip):
        rows = step(rows, change)
    return (
        rows.select(
            *(keep or []),
            "text",
            F.length("text").alias("num_chars"),
            F.size("_blocks").alias("num_code_blocks"),
            F.when(F.size("_blocks") > 0, F.array_join("_blocks", "\n\n")).alias("code_blocks"),
            "license",
        )
    )


def corpus_statistics(records: DataFrame, *levels: str) -> DataFrame:
    """Record, character and block totals per level and overall."""
    return records.rollup(*levels).agg(
        F.count(F.lit(1)).alias("records"),
        F.sum("num_chars").alias("num_chars"),
        F.sum("num_code_blocks").alias("num_code_blocks"),
        F.avg("num_chars").alias("avg_chars"),
    )
