"""Incremental forms of the corpus and retrieval jobs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from inkstrata.functions import vectors as vx
from inkstrata.operators.chunking import Chunker
from inkstrata.operators.cleaning import process_examples
from inkstrata.operators.ingest import ingest
from inkstrata.operators.numbering import number_rows
from inkstrata.operators.sinks import SHARD_SIZE
from inkstrata.session import materialize


def file_stream(
    spark: SparkSession, folder: str, schema: StructType, pattern: str = "*.parquet", files_per_batch: int | None = None
) -> DataFrame:
    """Parquet files that arrive in a folder."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def append_files(stream: DataFrame, out: str, progress: str, shard_size: int = SHARD_SIZE) -> StreamingQuery:
    """Write what has arrived, then stop.

    ``progress`` keeps what is done: a later or a broken-off run goes on from
    there and writes nothing twice.
    """
    return (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", progress)
        .option("maxRecordsPerFile", shard_size)
        .trigger(availableNow=True)
        .start()
    )


def clean_and_shard(
    raw: DataFrame, out: str, progress: str, text_field: str = "text", keep: list[str] | None = None,
    shard_size: int = SHARD_SIZE,
) -> StreamingQuery:
    """Incremental cleaning into files of at most ``shard_size`` records."""
    return append_files(process_examples(raw, text_field, keep), out, progress, shard_size)


def _carried(spark: SparkSession, state: str, batch_id: int) -> tuple[int, DataFrame | None]:
    """The number of the next shard, and the rows that wait for it, after the batches before ``batch_id``."""
    if batch_id == 0:
        return 1, None
    number = spark.read.schema("next bigint").parquet(f"{state}/next/{batch_id - 1}").first()["next"]
    return number, spark.read.parquet(f"{state}/rows/{batch_id - 1}")


def clean_to_full_shards(
    raw: DataFrame, out: str, progress: str, order_by: list[str], text_field: str = "text", keep: list[str] | None = None,
    shard_size: int = SHARD_SIZE,
) -> StreamingQuery:
    """Incremental cleaning into ``out/shard=N``, from 1 on, of exactly ``shard_size`` records.

    Rows that do not fill a shard are carried on to the next micro-batch, in front of
    what arrives there; :func:`flush_shards` writes what is left at the end. The rows of
    a micro-batch are in the order of ``order_by``, which are among ``keep``. Less than
    a shard is carried, and a batch of any size is numbered without a one-task window.
    A batch that runs again, after a broken-off run, writes the same shards again.
    """
    state = f"{progress}-carried"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        first, waiting = _carried(spark, state, batch_id)
        rows = process_examples(batch, text_field, keep).withColumns({"_late": F.lit(1), "_place": F.lit(0).cast("bigint")})
        if waiting is not None:
            rows = rows.unionByName(waiting.withColumn("_late", F.lit(0)))
        rows = materialize(rows, "arrived")
        numbered = materialize(number_rows(rows, ["_late", "_place", *order_by], out="_row", start=0), "numbered")
        full = numbered.count() // shard_size
        shard = (F.floor(F.col("_row") / shard_size) + first).cast("bigint")
        done = numbered.where(F.col("_row") < full * shard_size).withColumn("shard", shard).drop("_late", "_place", "_row")
        _write_numbered(done, out)
        left = numbered.where(F.col("_row") >= full * shard_size).withColumn("_place", F.col("_row")).drop("_late", "_row")
        left.coalesce(1).write.mode("overwrite").parquet(f"{state}/rows/{batch_id}")
        spark.createDataFrame([(batch_id, first + full)], "batch bigint, next bigint").coalesce(1).write.mode("overwrite").parquet(f"{state}/next/{batch_id}")

    return raw.writeStream.foreachBatch(write).option("checkpointLocation", progress).trigger(availableNow=True).start()


def _write_numbered(rows: DataFrame, out: str) -> None:
    # only the shards at hand are replaced
    spread = rows.repartition("shard").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    spread.partitionBy("shard").parquet(out)


def flush_shards(spark: SparkSession, out: str, progress: str) -> None:
    """Write the rows that no shard has been filled with as the last, shorter one.

    Should more arrive after all, the next run fills this shard up.
    """
    state = f"{progress}-carried"
    batches = spark.read.schema("batch bigint, next bigint").option("recursiveFileLookup", "true").parquet(f"{state}/next")
    last = batches.orderBy(F.desc("batch")).first()
    if last is not None:
        left = spark.read.parquet(f"{state}/rows/{last['batch']}").drop("_place")
        _write_numbered(left.withColumn("shard", F.lit(last["next"]).cast("bigint")), out)


def append_index(
    files: DataFrame, chunker: Chunker, out: str, progress: str,
    embed: Callable[[Column], Column] = vx.digest_embedding, base: Column | None = None,
) -> StreamingQuery:
    """Decoded files are chunked, embedded and appended to the index as they arrive."""
    return append_files(ingest(files, chunker, embed, base), out, progress)


def answer_stream(
    questions: DataFrame, answer: Callable[[DataFrame], DataFrame], out: str, progress: str
) -> StreamingQuery:
    """Answer arriving questions from the index as it is when they arrive.

    ``answer`` maps a batch of questions to answers. A batch overwrites its own
    folder, so a repeated one leaves a single copy.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        answer(batch).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return (
        questions.writeStream.foreachBatch(handle)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
