import pytest
from pyspark.sql import functions as F

from inkstrata.operators.cleaning import process_examples
from inkstrata.streaming import jobs as stream


def test_stream_equals_batch_and_restart_adds_nothing(spark, sf, tmp_path):
    raw = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    base = str(tmp_path)
    for part in range(3):
        raw.where(F.col("doc_id") % 3 == part).write.mode("append").parquet(f"{base}/in")
        arriving = stream.file_stream(spark, f"{base}/in", raw.schema, files_per_batch=1)
        query = stream.clean_and_shard(arriving, f"{base}/out", f"{base}/progress", keep=["doc_id"], shard_size=40)
        query.awaitTermination()
    arriving = stream.file_stream(spark, f"{base}/in", raw.schema)
    stream.clean_and_shard(arriving, f"{base}/out", f"{base}/progress", keep=["doc_id"], shard_size=40).awaitTermination()
    out = spark.read.parquet(f"{base}/out")
    want = process_examples(raw, keep=["doc_id"])
    assert out.count() == want.count()
    assert out.exceptAll(want).count() == 0
    by_file = out.groupBy(F.col("_metadata.file_path")).count().agg(F.max("count")).first()[0]
    assert by_file <= 40


def test_full_shards_over_arrivals_restarts_and_late_rows(spark, tmp_path):
    base = str(tmp_path)
    rows = spark.range(107).select("id", F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))

    def deliver(low, high):
        rows.where((F.col("id") >= low) & (F.col("id") < high)).write.mode("append").parquet(f"{base}/in")

    def run():
        arriving = stream.file_stream(spark, f"{base}/in", rows.schema)
        stream.clean_to_full_shards(arriving, f"{base}/out", f"{base}/progress", ["id"], keep=["id"], shard_size=10).awaitTermination()

    def shards():
        return sorted((r["shard"], r["id"]) for r in spark.read.parquet(f"{base}/out").collect())

    for low, high in ((0, 4), (4, 37), (37, 90)):
        deliver(low, high)
        run()
    run()
    assert shards() == [(1 + i // 10, i) for i in range(90)]
    deliver(90, 104)
    run()
    assert shards() == [(1 + i // 10, i) for i in range(100)]
    stream.flush_shards(spark, f"{base}/out", f"{base}/progress")
    assert shards() == [(1 + i // 10, i) for i in range(104)]
    # what comes after all fills the last shard up
    deliver(104, 107)
    run()
    stream.flush_shards(spark, f"{base}/out", f"{base}/progress")
    assert shards() == [(1 + i // 10, i) for i in range(107)]


def test_a_batch_that_runs_again_writes_the_same(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    rows = spark.range(25).select("id", F.lit("t").alias("text"))
    rows.write.parquet(f"{base}/in")

    def run():
        arriving = stream.file_stream(spark, f"{base}/in", rows.schema)
        stream.clean_to_full_shards(arriving, f"{base}/out", f"{base}/progress", ["id"], keep=["id"], shard_size=10).awaitTermination()

    with monkeypatch.context() as broken:
        write = stream._write_numbered

        def fail(*args):
            write(*args)
            raise RuntimeError("stopped after the shards were written")

        broken.setattr(stream, "_write_numbered", fail)
        with pytest.raises(Exception, match="stopped"):
            run()
    run()
    stream.flush_shards(spark, f"{base}/out", f"{base}/progress")
    assert sorted((r["shard"], r["id"]) for r in spark.read.parquet(f"{base}/out").collect()) == [(1 + i // 10, i) for i in range(25)]
