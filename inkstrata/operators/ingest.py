"""Files to chunks: decoding, conversion by extension, metadata."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkstrata.functions import text as tx
from inkstrata.functions import vectors as vx
from inkstrata.operators import chunking
from inkstrata.operators.vocabulary import bounded_parts

# Extensions by converter, and the metadata keys every chunk has.
MARKDOWN_SUFFIXES = (".md", ".markdown")
HTML_SUFFIXES = (".html", ".htm")
METADATA_KEYS = ("file_path", "repo", "commit", "source")


def converter_name(path: Column) -> Column:
    """``markdown``, ``html`` or null where no converter takes the file."""
    suffix = F.lower(tx.file_suffix(path))
    return F.when(suffix.isin(*MARKDOWN_SUFFIXES), "markdown").when(suffix.isin(*HTML_SUFFIXES), "html")


def supported(path: str) -> bool:
    return path.lower().endswith(MARKDOWN_SUFFIXES + HTML_SUFFIXES)


def decode_files(files: DataFrame) -> DataFrame:
    """``(path, content BINARY)`` to ``(path, converter, text)``.

    Files without a converter and files that are not UTF-8 are left out; line
    ends become ``\\n``.
    """
    return (
        files.withColumn("converter", converter_name(F.col("path")))
        .where(F.col("converter").isNotNull() & F.is_valid_utf8(F.col("content").cast("string")))
        .select(
            *[c for c in files.columns if c != "content"],
            "converter",
            tx.universal_newlines(F.col("content").cast("string")).alias("text"),
        )
    )


def html_text(markup: str) -> str:
    """Text nodes of a page in document order, joined without separator."""
    nodes: list[str] = []
    parser = HTMLParser()
    parser.handle_data = nodes.append  # type: ignore[method-assign]
    parser.feed(markup)
    return "".join(nodes)


@F.pandas_udf(T.StringType())
def html_to_text(markup: pd.Series) -> pd.Series:
    return markup.map(html_text, na_action="ignore")


def convert(files: DataFrame) -> DataFrame:
    """Markdown passes as it is, HTML is reduced to its text.

    The files are read once; Python is handed the pages only, and a null for
    every other file.
    """
    page = F.when(F.col("converter") == "html", F.col("text"))
    return files.withColumn("text", F.coalesce(html_to_text(page), F.col("text")))


def build_metadata(
    path: Column, base: Column | None = None, repo: str | None = None, commit: str | None = None
) -> Column:
    """Metadata map of a file: the caller's entries win over the defaults."""
    defaults = F.create_map(
        F.lit("file_path"), path,
        F.lit("repo"), F.lit(repo or "unknown"),
        F.lit("commit"), F.lit(commit or tx.DEFAULT_COMMIT),
        F.lit("source"), F.regexp_replace(tx.file_suffix(path), r"^\.", ""),
    )
    if base is None:
        return defaults
    given = F.coalesce(base, F.create_map().cast("map<string,string>"))
    missing = F.map_filter(defaults, lambda k, v: ~F.map_contains_key(given, k))
    return F.map_concat(given, missing)


def apply_converters(
    files: DataFrame, converters: Mapping[str, Callable[[str], Iterable[str]]], keep: tuple[str, ...] = ("path",)
) -> DataFrame:
    """Callers' converters: a text becomes any number of chunks.

    ``converters`` maps a lower-case suffix with its dot to a function; files
    with another suffix are left out. Texts are taken in parts of some megabytes.
    """
    kept = list(keep)
    types = {f.name: f.dataType.simpleString() for f in files.schema.fields}
    schema = ", ".join([*(f"{c} {types[c]}" for c in kept), "chunk_index int", "content string"])
    table = dict(converters)
    chosen = files.withColumn("_suffix", F.lower(tx.file_suffix(F.col("path")))).where(
        F.col("_suffix").isin(*table)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in bounded_parts(whole)):
            rows, places, contents = [], [], []
            for row, (suffix, text) in enumerate(zip(batch.column("_suffix").to_pylist(), batch.column("text").to_pylist())):
                for place, piece in enumerate(table[suffix](text)):
                    # missing pieces are left out, and keep their place
                    if piece is not None and piece == piece:
                        rows.append(row)
                        places.append(place)
                        contents.append(piece)
            own = [batch.column(c).take(pa.array(rows, pa.int64())) for c in kept]
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array(places, pa.int32()), pa.array(contents, pa.string())], names=[*kept, "chunk_index", "content"]
            )

    return chosen.select(*kept, "_suffix", "text").mapInArrow(run, schema)


def ingest(
    files: DataFrame,
    chunker: chunking.Chunker,
    embed: Callable[[Column], Column] = vx.digest_embedding,
    base: Column | None = None,
    repo: str | None = None,
    commit: str | None = None,
) -> DataFrame:
    """Decoded files to index rows: position, content, metadata, embedding.

    ``base`` may refer to columns of ``files``.
    """
    described = convert(files).withColumn("metadata", build_metadata(F.col("path"), base, repo, commit))
    chunks = chunking.drop_blank(chunking.chunk(described, chunker))
    return chunks.withColumn("embedding", embed(F.col("content")))
