"""Callers' encoders that are built once, and key rings."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from inkstrata.operators import answering, governance


def test_encoder_is_built_once_in_each_worker(spark, tmp_path):
    place = str(tmp_path)

    def build():
        open(f"{place}/{os.getpid()}-{uuid.uuid4().hex}", "w").close()
        return lambda texts: [[float(len(t)), float(os.getpid())] for t in texts]

    rows = spark.range(400).select(F.col("id").cast("string").alias("text")).repartition(16)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        made = rows.withColumn("v", answering.encode_with_built(build, F.col("text"))).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert all(r["v"][0] == len(r["text"]) for r in made)
    builds = [name.split("-")[0] for name in os.listdir(tmp_path)]
    assert sorted(builds) == sorted({str(int(r["v"][1])) for r in made})


def test_empty_table_builds_nothing(spark):
    rows = spark.createDataFrame([], "text string")
    assert rows.withColumn("v", answering.encode_with_built(lambda: 1 / 0, F.col("text"))).collect() == []


@pytest.fixture
def index(spark):
    rows = [(i, f"text {i}", {"file_path": f"p{i}"}) for i in range(20)]
    return spark.createDataFrame(rows, "i int, content string, metadata map<string,string>")


def plain(df):
    return sorted((r["i"], r["content"], r["metadata"]["file_path"]) for r in df.collect())


def test_half_rotated_index(spark, index, tmp_path):
    ring = {"old": os.urandom(32), "new": os.urandom(32)}
    governance.seal(index, ring, "old").write.parquet(f"{tmp_path}/old")
    old = spark.read.parquet(f"{tmp_path}/old")
    governance.rotate(old.where("i < 8"), ring, "new").unionByName(old.where("i >= 8")).write.parquet(f"{tmp_path}/half")
    half = spark.read.parquet(f"{tmp_path}/half")
    assert {(r["key_id"], r["n"]) for r in half.groupBy("key_id").agg(F.count("i").alias("n")).collect()} == {("new", 8), ("old", 12)}
    # rows under both keys are read at once
    assert plain(governance.unseal(half, ring)) == plain(index)
    governance.rotate(half, ring, "new").write.parquet(f"{tmp_path}/new")
    new = spark.read.parquet(f"{tmp_path}/new")
    assert plain(governance.unseal(new, {"new": ring["new"]})) == plain(index)
    # rows that were rotated before are not encrypted again
    before, after = ({r["i"]: bytes(r["content"]) for r in t.collect()} for t in (half.where("i < 8"), new.where("i < 8")))
    assert before == after
    assert new.columns == old.columns


def test_a_key_that_is_not_in_the_ring_is_an_error(index):
    sealed = governance.seal(index, {"a": b"k" * 32}, "a")
    with pytest.raises(Exception, match="no key in the ring for key id a"):
        governance.unseal(sealed, {"b": b"x" * 32}).collect()
    with pytest.raises(ValueError):
        governance.seal(index, {"a": b"short"}, "a")


def test_no_plan_names_a_key(index):
    key = b"0123456789abcdef" * 2
    plan = governance.unseal(governance.seal(index, {"a": key}, "a"), {"a": key})._jdf.queryExecution().toString()
    assert key.decode() not in plan and key.hex() not in plan.lower()
