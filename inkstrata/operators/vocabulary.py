"""Word and character tables, frequency vocabularies, word-level encoding."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkstrata.functions import text as tx

# The special ids; a vocabulary starts with these pieces.
PAD, UNK, BOS, EOS = 0, 1, 2, 3
SPECIAL_PIECES = ("<pad>", "<unk>", "<s>", "</s>")
CHARACTER_COVERAGE = 0.9995
VOCAB_SIZE = 65_536
# Bytes of word lists that are looked up at once.
LOOKUP_BYTES = 4 << 20
# White space as part of the word behind it, for piece models.
SPACE_MARK = "▁"
MARKED_BREAK = f"(?=[{SPACE_MARK}0-9])|(?<=[0-9])"
SPACED_BREAK = r"(?=[\t-\r ])|(?<=[\t-\r ])"


def count_words(texts: DataFrame, text: str = "text") -> DataFrame:
    """``word, n`` over the whole corpus."""
    return _count(texts, tx.words(F.col(text)))


def marked_words(text: Column) -> Column:
    """Words that keep the space before them; together they give the text back.

    White space is unified to single spaces first, and digits stand alone.
    """
    stripped = tx.strip(text)
    # a mark in front, unless there is nothing to mark
    fronted = F.concat(F.substring(F.lit(SPACE_MARK), F.lit(1), F.least(F.length(stripped), F.lit(1))), stripped)
    marked = F.regexp_replace(fronted, f"{tx.SPACE_CLASS}+", SPACE_MARK)
    return F.array_remove(F.split(marked, MARKED_BREAK), "")


def count_marked_words(texts: DataFrame, text: str = "text") -> DataFrame:
    """``word, n`` of :func:`marked_words`; only the distinct texts between white space are taken apart."""
    between = _count(texts, F.array_remove(F.split(F.col(text), f"{tx.SPACE_CLASS}+"), ""))
    words = F.array_remove(F.split(F.concat(F.lit(SPACE_MARK), F.col("word")), MARKED_BREAK), "")
    return between.select(F.explode(words).alias("word"), "n").groupBy("word").agg(F.sum("n").alias("n"))


def _count(texts: DataFrame, words: Column) -> DataFrame:
    # partial counts per task come before the shuffle, so frequent words stay cheap
    return texts.select(F.explode(words).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def count_characters(texts: DataFrame, text: str = "text") -> DataFrame:
    """``ch, n`` over the whole corpus, white space included.

    Words are counted first; only the distinct ones are taken apart.
    """
    return word_characters(_count(texts, F.array_remove(F.split(F.col(text), SPACED_BREAK), "")))


def word_characters(words: DataFrame) -> DataFrame:
    """``ch, n`` of counted words."""
    return (
        words.select(F.explode(tx.characters(F.col("word"))).alias("ch"), "n")
        .groupBy("ch")
        .agg(F.sum("n").alias("n"))
    )


def alphabet(characters: DataFrame, coverage: float = CHARACTER_COVERAGE) -> DataFrame:
    """The most frequent characters that together reach the coverage.

    The window has no groups, but its table has one row per character.
    """
    so_far = Window.orderBy(F.desc("n"), "ch").rowsBetween(Window.unboundedPreceding, -1)
    total = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (
        characters.withColumn("_before", F.coalesce(F.sum("n").over(so_far), F.lit(0)))
        .withColumn("_total", F.sum("n").over(total))
        .where(F.col("_before") < F.col("_total") * coverage)
        .select("ch", "n")
    )


def byte_pieces(ch: Column) -> Column:
    """UTF-8 bytes of a character as ``<0xNN>`` pieces."""
    digits = F.hex(F.encode(ch, "UTF-8"))
    return F.transform(
        F.regexp_extract_all(digits, F.lit(".."), F.lit(0)), lambda b: F.concat(F.lit("<0x"), b, F.lit(">"))
    )


def byte_fallback(characters: DataFrame, kept: DataFrame) -> DataFrame:
    """Pieces of every character: itself, or its bytes where the alphabet lacks it."""
    # the alphabet is a part of one character set, some 150 000 at the very most
    known = F.broadcast(kept.select("ch", F.lit(True).alias("_known")))
    return characters.join(known, "ch", "left").select(
        "ch",
        "n",
        F.when(F.col("_known"), F.array("ch")).otherwise(byte_pieces(F.col("ch"))).alias("pieces"),
    )


def frequency_vocabulary(words: DataFrame, size: int = VOCAB_SIZE) -> DataFrame:
    """``piece, id``: the special pieces, then words by falling count.

    ``size`` counts the special pieces. Ids are given to a table of that size.
    """
    spark = words.sparkSession
    specials = spark.createDataFrame(list(enumerate(SPECIAL_PIECES)), "id bigint, piece string")
    top = words.orderBy(F.desc("n"), "word").limit(max(0, size - len(SPECIAL_PIECES)))
    ranked = top.select(
        F.col("word").alias("piece"),
        (F.row_number().over(Window.orderBy(F.desc("n"), "word")) + (len(SPECIAL_PIECES) - 1))
        .cast("bigint")
        .alias("id"),
    )
    return specials.select("piece", "id").unionByName(ranked)


def bounded_parts(batch: pa.RecordBatch, most: int = LOOKUP_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in order, in parts of about ``most`` bytes or of one row."""
    rows = batch.num_rows
    step = max(1, rows * most // max(batch.nbytes, 1))
    for at in range(0, rows, step):
        yield batch.slice(at, step)


def encode_words(
    texts: DataFrame,
    vocabulary: DataFrame,
    key: str | Sequence[str],
    text: str = "text",
    limit: int | None = None,
) -> DataFrame:
    """``key, ids``: the vocabulary id of each word in order, unknown words as ``UNK``.

    Nothing is shuffled: Spark takes the texts apart, and some megabytes of words are
    looked up together in the vocabulary, whose size is the parameter it was built
    with. With ``limit`` only so many leading ids are wanted, as in a training
    example. A null text has no ids.
    """
    keys = [key] if isinstance(key, str) else list(key)
    words = F.coalesce(tx.words(F.col(text)), F.array().cast("array<string>"))
    if limit is not None:
        words = F.slice(words, 1, limit)
    rows = texts.select(*keys, words.alias("_words"))
    table = vocabulary.select("piece", F.col("id").cast("int").alias("id")).toArrow()
    shared = texts.sparkSession.sparkContext.broadcast(
        (table.column("piece").combine_chunks(), table.column("id").combine_chunks())
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, numbers = shared.value
        for batch in (part for whole in batches for part in bounded_parts(whole)):
            lists = batch.columns[-1]
            places = pc.index_in(lists.flatten(), value_set=pieces.cast(lists.type.value_type))
            found = pc.fill_null(numbers.take(places), pa.scalar(UNK, numbers.type))
            start = lists.offsets[0].as_py() if len(lists) else 0
            offsets = pc.subtract(lists.offsets, pa.scalar(start, lists.offsets.type))
            ids = type(lists).from_arrays(offsets, found)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], ids], names=[*keys, "ids"])

    fields = [rows.schema[k] for k in keys]
    return rows.mapInArrow(run, T.StructType([*fields, T.StructField("ids", T.ArrayType(T.IntegerType()))]))
