"""Prompts, answers and citations from search hits."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkstrata.functions import text as tx

DEFAULT_TOP_K = 4


def effective_top_k(top_k: int | None) -> int:
    """Zero and a missing value ask for the default."""
    return top_k or DEFAULT_TOP_K


Encoder = Callable[[list[str]], list[list[float]]]

# The encoder that this Python worker has built, by the call it was built for.
_built: dict[str, Encoder] = {}


def _vectors(encoder: Encoder, batch: pd.Series) -> pd.Series:
    if batch.empty:
        return pd.Series([], dtype=object)
    return pd.Series([[float(x) for x in row] for row in encoder(batch.tolist())], index=batch.index)


def _built_here(call: str, build: Callable[[], Encoder]) -> Encoder:
    if call not in _built:
        _built.clear()
        _built[call] = build()
    return _built[call]


def encode_with(encoder: Encoder, text: Column) -> Column:
    """A caller's batch encoder as a column; it sees whole Arrow batches."""

    @F.pandas_udf("array<double>")
    def encode(batch: pd.Series) -> pd.Series:
        return _vectors(encoder, batch)

    return encode(text)


def encode_with_built(build: Callable[[], Encoder], text: Column) -> Column:
    """As :func:`encode_with`, for encoders that are costly to build, such as loaded models.

    ``build`` is called once in each Python worker, at its first batch, and not for
    each batch or task; what another call has built there is let go.
    """
    call = uuid.uuid4().hex

    @F.pandas_udf("array<double>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield _vectors(_built_here(call, build), batch)

    return encode(text)


def generate_with(generator: Callable[[str], str] | None, prompt: Column) -> Column:
    """A caller's generator as a column; by default the text after the answer marker."""
    if generator is None:
        return tx.text_after_marker(prompt)

    @F.pandas_udf("string")
    def generate(batch: pd.Series) -> pd.Series:
        return batch.map(generator)

    return generate(prompt)


def assemble_answers(
    questions: DataFrame,
    hits: DataFrame,
    query_id: str = "query_id",
    question: str = "question",
    generator: Callable[[str], str] | None = None,
) -> DataFrame:
    """One row per question: prompt, answer and ranked citations.

    ``hits`` has ``rank, content, file_path, commit, score`` per question, at
    most k of them, so the lists gathered here are short.
    """
    gathered = hits.groupBy(query_id).agg(
        F.sort_array(
            F.collect_list(F.struct("rank", "content", "file_path", "commit", "score"))
        ).alias("_hits")
    )
    empty = F.array().cast(gathered.schema["_hits"].dataType)
    found = F.col("_hits")
    blocks = F.transform(found, lambda h: tx.context_block(h["rank"], h["file_path"], h["commit"], h["content"]))
    citations = F.transform(
        found,
        lambda h: F.struct(
            F.concat(F.lit("["), h["rank"].cast("string"), F.lit("]")).alias("label"),
            F.coalesce(h["file_path"], F.lit(tx.UNKNOWN_PATH)).alias("file_path"),
            F.coalesce(h["commit"], F.lit(tx.DEFAULT_COMMIT)).alias("commit"),
            h["score"].alias("score"),
        ),
    )
    prompted = (
        questions.join(gathered, query_id, "left")
        .withColumn("_hits", F.coalesce(found, empty))
        .withColumn("prompt", tx.retrieval_prompt(F.col(question), blocks))
    )
    return prompted.select(
        query_id,
        question,
        "prompt",
        generate_with(generator, F.col("prompt")).alias("answer"),
        citations.alias("citations"),
    )


def citation_report(citations: Column) -> Column:
    """Printable citation lines, one per hit."""
    lines = F.transform(
        citations,
        lambda c: F.concat(
            c["label"], F.lit(" "), tx.citation(c["file_path"], c["commit"]),
            F.format_string(tx.SCORE_FORMAT, c["score"]),
        ),
    )
    return F.when(F.size(citations) > 0, F.array_join(lines, "\n")).otherwise(F.lit(tx.NO_CITATIONS))
