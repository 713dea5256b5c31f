"""Queries: word tables, vocabularies, encoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkstrata.catalog.base import (
    SQL_VOCABULARY, SQL_WORDS, VOCABULARY, joined, query, sql_encoded, sql_strip, table, vocabulary, SQL_SPACE,
)
from inkstrata.functions import tokens as tk
from inkstrata.operators import bpe, sinks, unigram
from inkstrata.operators import vocabulary as vb
from inkstrata.session import fresh_dir, materialize

SQL_CHARACTERS = """
chars AS (SELECT ch, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '(?s).')) AS ch FROM documents) GROUP BY ch),
ranked AS (SELECT ch, n, coalesce(sum(n) OVER (ORDER BY n DESC, ch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
  AS before, sum(n) OVER () AS total FROM chars),
letters AS (SELECT ch, n FROM ranked WHERE before < total * 0.9995)"""


def characters(spark, sf):
    return vb.count_characters(table(spark, sf, "documents"))


@query("j1_character_coverage", f"WITH {SQL_CHARACTERS} SELECT ch, n FROM letters")
def _(spark, sf):
    return vb.alphabet(characters(spark, sf))


@query(
    "j2_word_counts",
    f"SELECT word, count(*) AS n FROM (SELECT unnest({SQL_WORDS}) AS word FROM documents) GROUP BY word",
)
def _(spark, sf):
    return vb.count_words(table(spark, sf, "documents"))


@query(
    "j3_byte_fallback",
    f"""WITH {SQL_CHARACTERS} SELECT c.ch, c.n, CASE WHEN l.ch IS NOT NULL THEN c.ch ELSE
      regexp_replace(hex(encode(c.ch)), '(..)', '<0x\\1>', 'g') END AS pieces
    FROM chars c LEFT JOIN letters l ON l.ch = c.ch""",
)
def _(spark, sf):
    counted = characters(spark, sf)
    return vb.byte_fallback(counted, vb.alphabet(counted)).withColumn("pieces", F.array_join("pieces", ""))


@query(
    "j4_frequency_vocabulary",
    f"""WITH {SQL_VOCABULARY} SELECT piece, id FROM vocab
    UNION ALL SELECT '<pad>', 0 UNION ALL SELECT '<unk>', 1 UNION ALL SELECT '<s>', 2 UNION ALL SELECT '</s>', 3""",
)
def _(spark, sf):
    return vocabulary(spark, sf)


SQL_MARKED = f"""
spaced AS (SELECT doc_id, '▁' || regexp_replace({sql_strip('text')}, '{SQL_SPACE}+', '▁', 'g') AS text FROM documents
  WHERE length({sql_strip('text')}) > 0),
marked AS (SELECT word, count(*) AS n FROM (
  SELECT unnest(regexp_extract_all(text, '[0-9]|▁[^0-9▁]*|[^0-9▁]+')) AS word FROM spaced) GROUP BY word)"""


def marked_words(spark, sf):
    return vb.count_marked_words(table(spark, sf, "documents"))


@query(
    "j5_bpe_pair_counts",
    f"""WITH {SQL_MARKED},
    places AS (SELECT word, n, unnest(range(1, length(word))) AS i FROM marked WHERE length(word) > 1)
    SELECT substr(word, i, 1) AS "left", substr(word, i + 1, 1) AS "right", CAST(sum(n) AS BIGINT) AS n
    FROM places GROUP BY ALL""",
)
def _(spark, sf):
    return bpe.count_pairs(bpe.start_symbols(marked_words(spark, sf)))


MERGES = 16
# Merges of the codec query; a round of learning is a Spark job.
CODEC_MERGES = 400

# One merge per step: count the pairs, take the best, replace it everywhere.
SQL_MERGES = f"""WITH RECURSIVE {SQL_MARKED},
    steps AS (
      SELECT 0 AS step, '' AS l, '' AS r, CAST(0 AS BIGINT) AS c,
        chr(2) || array_to_string(regexp_extract_all(word, '(?s).'), chr(3) || chr(2)) || chr(3) AS symbols, n FROM marked
      UNION ALL
      SELECT step + 1, b.l, b.r, b.c,
        replace(symbols, chr(2) || b.l || chr(3) || chr(2) || b.r || chr(3), chr(2) || b.l || b.r || chr(3)), n
      FROM steps, (
        SELECT p[1] AS l, p[2] AS r, CAST(sum(n) AS BIGINT) AS c FROM (
          SELECT unnest(list_zip(parts[:-2], parts[2:])) AS p, n FROM (
            SELECT string_split(symbols[2:-2], chr(3) || chr(2)) AS parts, n FROM steps) WHERE len(parts) > 1)
        GROUP BY p ORDER BY c DESC, l, r LIMIT 1) b
      WHERE step < {MERGES})
    SELECT DISTINCT CAST(step AS INTEGER) AS "rank", l AS "left", r AS "right", c AS n FROM steps WHERE step > 0"""


@query("j5_bpe_merges", SQL_MERGES)
def _(spark, sf):
    return bpe.merge_table(spark, bpe.learn_merges(marked_words(spark, sf), MERGES))


def letters(words):
    """The alphabet of counted words, at most as long as the character set."""
    return [r["ch"] for r in vb.alphabet(vb.word_characters(words)).collect()]


# Pieces besides the special and byte ones, which the reference's size includes.
PIECES = VOCABULARY - len(vb.SPECIAL_PIECES) - 256


@query("j6_unigram_vocabulary")
def _(spark, sf):
    words = materialize(marked_words(spark, sf), "marked")
    return unigram.model_table(spark, unigram.learn_unigram(words, letters(words), PIECES))


@query(
    "j7_encode_words",
    f"WITH {SQL_VOCABULARY}, {sql_encoded('documents', 'doc_id')} "
    "SELECT doc_id, array_to_string(ids, ' ') AS ids FROM encoded",
)
def _(spark, sf):
    encoded = vb.encode_words(table(spark, sf, "documents"), vocabulary(spark, sf), "doc_id")
    return encoded.select("doc_id", joined("ids").alias("ids"))


SQL_UNIFIED = f"SELECT doc_id, regexp_replace({sql_strip('text')}, '{SQL_SPACE}+', ' ', 'g') AS text FROM documents"


@query("j7_encode_bpe", SQL_UNIFIED)
def _(spark, sf):
    # encoded and decoded again: nothing of a text may get lost
    words = materialize(marked_words(spark, sf), "marked")
    merges, known = bpe.learn_merges(words, CODEC_MERGES), letters(words)
    encoded = bpe.encode(table(spark, sf, "documents").select("doc_id", "text"), known, merges)
    return encoded.select("doc_id", bpe.decode_column(F.col("ids"), bpe.piece_ids(known, merges)).alias("text"))


@query("j7_encode_unigram", SQL_UNIFIED)
def _(spark, sf):
    words = materialize(marked_words(spark, sf), "marked")
    model = unigram.learn_unigram(words, letters(words), PIECES)
    encoded = unigram.encode(table(spark, sf, "documents").select("doc_id", "text"), model)
    return encoded.select("doc_id", bpe.decode_column(F.col("ids"), unigram.piece_ids(model)).alias("text"))


@query(
    "j8_special_ids",
    "SELECT doc_id, '0 ' || length(text) || ' 0' AS without_ids, '2 ' || length(text) || ' 3' AS with_ids FROM documents",
)
def _(spark, sf):
    # a model without padding and start ids, and one that has both
    def row(pad_id, bos_id):
        pad, bos = tk.resolve_special_ids(pad_id, bos_id)
        return joined(tk.fixed_length(F.array(F.length("text")), 3, bos, pad))

    return table(spark, sf, "documents").select(
        "doc_id", row(-1, -1).alias("without_ids"), row(3, 2).alias("with_ids")
    )


@query(
    "b6_tokenizer_record",
    f"""WITH {SQL_VOCABULARY} SELECT 'documents' AS sources, CAST(4 + count(*) AS INTEGER) AS vocab_size,
    'word' AS model_type, CAST(0.9995 AS DOUBLE) AS character_coverage FROM vocab""",
)
def _(spark, sf):
    path = fresh_dir(spark, "tokenizer")
    pieces = vocabulary(spark, sf)
    pieces.write.parquet(f"{path}/vocabulary")
    size = spark.read.parquet(f"{path}/vocabulary").count()
    sinks.write_json(
        sinks.tokenizer_record(spark, ["documents"], size, "word", vb.CHARACTER_COVERAGE), f"{path}/record"
    )
    back = spark.read.schema(
        "sources array<string>, vocab_size int, model_type string, character_coverage double"
    ).json(f"{path}/record")
    return back.withColumn("sources", F.array_join("sources", " "))
