"""Writers: shards, index export, corpora, JSON records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkstrata.operators.numbering import number_rows

SHARD_SIZE = 2000


def assign_shards(
    records: DataFrame, order_by: list[str], shard_size: int = SHARD_SIZE, per: tuple[str, ...] = ("dataset", "split")
) -> DataFrame:
    """Adds ``shard``, counted from 1 per dataset and split in the given order."""
    numbered = number_rows(records, order_by, per, out="_row", start=0)
    return numbered.withColumn("shard", (F.floor(F.col("_row") / shard_size) + 1).cast("bigint")).drop("_row")


def shard_name(shard):
    return F.concat(F.lit("shard-"), F.lpad(shard.cast("string"), 5, "0"))


def write_shards(records: DataFrame, root: str, shard_size: int = SHARD_SIZE) -> None:
    """Files of at most ``shard_size`` records below ``dataset=/split=``.

    Rows of a dataset and split are brought together in parts of the advised size,
    as many as they fill, so that tasks do not leave a small file each.
    """
    (
        records.hint("rebalance", "dataset", "split")
        .write.mode("append")
        .option("maxRecordsPerFile", shard_size)
        .partitionBy("dataset", "split")
        .parquet(root)
    )


def write_exact_shards(sharded: DataFrame, root: str) -> None:
    """One file per shard of :func:`assign_shards`, full but for the last one."""
    (
        sharded.withColumn("shard", shard_name(F.col("shard")))
        .repartition("dataset", "split", "shard")
        .write.mode("append")
        .partitionBy("dataset", "split", "shard")
        .parquet(root)
    )


def index_export(index: DataFrame) -> DataFrame:
    """What leaves the index: text and metadata, no vectors."""
    return index.select(F.col("content").alias("text"), "metadata")


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines; used for exports, samples, problems, metrics and run records."""
    df.write.json(path)


def corpus_lines(texts: DataFrame) -> DataFrame:
    """A line-oriented corpus: embedded newlines start new lines."""
    return texts.select(F.explode(F.split("text", "\n")).alias("value"))


def write_corpus(texts: DataFrame, path: str) -> None:
    # a text holds its newlines already, so the writer gets it whole
    texts.select("text").write.text(path)


def tokenizer_record(spark, sources: list[str], vocab_size: int, model_type: str, coverage: float) -> DataFrame:
    """Run record that is stored beside a vocabulary."""
    return spark.createDataFrame(
        [(list(sources), vocab_size, model_type, coverage)],
        "sources array<string>, vocab_size int, model_type string, character_coverage double",
    )
