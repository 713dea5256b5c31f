"""Sliding character windows over texts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkstrata.functions import text as tx
from inkstrata.functions.binding import let


@dataclass(frozen=True)
class Chunker:
    """Windows of ``size`` characters that share ``overlap`` with the one before."""

    size: int = 512
    overlap: int = 64

    def __post_init__(self) -> None:
        if self.size <= 0:
            raise ValueError("chunk size must be positive")
        if self.overlap < 0:
            raise ValueError("chunk overlap must not be negative")
        if self.overlap >= self.size:
            raise ValueError("chunk overlap must be smaller than the chunk size")

    @property
    def step(self) -> int:
        return self.size - self.overlap

    def count(self, text: Column) -> Column:
        """How many windows a text has; the last one ends where the text ends."""
        more = F.ceil((F.length(text) - self.size) / F.lit(self.step)).cast("int") + 1
        return F.when(F.length(text) == 0, F.lit(0)).when(F.length(text) <= self.size, F.lit(1)).otherwise(more)

    def windows(self, text: Column) -> Column:
        """All windows of a text as an array.

        The text is cut once into pieces of one step, and each window is put
        together from the pieces it spans: linear in the text, where a substring
        per window would walk from the start of the text every time.
        """
        span = -(-self.size // self.step)

        def assemble(pieces: Column) -> Column:
            def window(i: Column) -> Column:
                joined = F.array_join(F.slice(pieces, i + 1, F.lit(span)), "")
                return F.substring(joined, 1, self.size)

            count = self.count(text)
            # a sequence to -1 would count down, so empty texts go their own way
            return F.when(count > 0, F.transform(F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))), window)).otherwise(
                F.array().cast("array<string>")
            )

        pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{self.step}}}"), F.lit(0))
        return let(pieces, assemble)


def chunk(df: DataFrame, chunker: Chunker, text: str = "text", out: str = "content") -> DataFrame:
    """One row per window with its ``chunk_index``; the text itself is not copied along."""
    others = [c for c in df.columns if c != text]
    return df.select(*others, F.posexplode(chunker.windows(F.col(text))).alias("chunk_index", out))


def drop_blank(chunks: DataFrame, column: str = "content") -> DataFrame:
    """Strip the chunks and drop those with nothing left; the index keeps its gaps."""
    return chunks.withColumn(column, tx.strip(F.col(column))).where(F.length(column) > 0)
