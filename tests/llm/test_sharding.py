import zlib

import pytest

from inkstrata.llm import sharding
from tests.llm.helpers import documents, odd


def assigned(spark, texts, shards):
    # the documents have a column ``shard`` of their own
    return sharding.shard(documents(spark, texts), shards, shard_column="part").collect()


@pytest.mark.parametrize("shards", [1, 4, 40])
def test_shards_are_near_equal_in_bytes(spark, shards):
    texts = [(i, f"text {i} " * (i % 17)) for i in range(600)] + [(1000 + i, "one text of many copies " * 3) for i in range(400)]
    rows = assigned(spark, texts, shards)
    assert len(rows) == len(texts)
    sizes = [0] * shards
    slots = [[] for _ in range(shards)]
    largest = 0
    for r in rows:
        size = len((r.text or "").encode()) + 16
        sizes[r.part] += size
        slots[r.part].append(r.slot)
        largest = max(largest, size)
    assert all(abs(size - sum(sizes) / shards) <= largest for size in sizes)
    assert all(sorted(own) == list(range(len(own))) for own in slots)


def test_equal_texts_lie_together(spark):
    rows = assigned(spark, [(i, f"t{i % 5}") for i in range(500)], 10)
    order = [r.text for r in sorted(rows, key=lambda r: (r.part, r.slot))]
    assert sum(a != b for a, b in zip(order, order[1:])) == 4


def test_odd_rows_empty_table_and_files(spark, tmp_path):
    assert len(assigned(spark, odd(), 40)) == len(odd())
    assert assigned(spark, [], 40) == []
    docs = documents(spark, odd())
    sharding.write_shards(docs, str(tmp_path / "out"), 3, shard_column="part")
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(odd())


def test_rank_counts_boundaries_below():
    import numpy as np

    bounds = [(1, 5), (1, 9), (4, -3)]
    keys, ties = np.array([0, 1, 1, 1, 4, 9]), np.array([0, 4, 5, 10, -4, 0])
    assert sharding.rank(bounds, keys, ties).tolist() == [0, 0, 1, 2, 2, 3]


def test_query_reads_its_rows_from_shard_files(spark, sf):
    from inkstrata.llm.queries import QUERIES

    made = QUERIES["op9_sharding"](spark, sf)
    files = made.inputFiles()
    assert files and all("/shards-" in f and "/shard=" in f for f in files)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = made.collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    assert all((r.size, r.text_crc32) == (len(texts[r.doc_id].encode()) + 16, zlib.crc32(texts[r.doc_id].encode())) for r in rows)
    for shard in {r.shard for r in rows}:
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))


@pytest.mark.parametrize("equal, others, shards", [(3000, 1000, 8), (500, 0, 7), (40, 3, 40), (5, 0, 8)])
def test_equal_rows_are_cut_between_shards(spark, equal, others, shards):
    texts = [(None, "one text of many")] * equal + [(i, f"text {i:09d}") for i in range(others)]
    rows = assigned(spark, texts, shards)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in rows) == sorted((i is None, i or 0, t) for i, t in texts)
    sizes = [0] * shards
    slots = [[] for _ in range(shards)]
    for r in rows:
        sizes[r.part] += len(r.text) + 16
        slots[r.part].append(r.slot)
    one = len("one text of many") + 16
    assert max(sizes) - min(sizes) <= 2 * one
    assert all(abs(size - sum(sizes) / shards) <= one for size in sizes)
    assert all(sorted(own) == list(range(len(own))) for own in slots)


def test_columns_of_any_names_are_kept(spark, tmp_path):
    names = ("key", "tie", "size", "cell", "row", "_key", "_size", "_cell", "copies", "first")
    docs = documents(spark, [(i, f"t{i % 3}") for i in range(30)]).drop("shard")
    for i, name in enumerate(names):
        docs = docs.withColumn(name, docs.doc_id * 100 + i)
    sharding.write_shards(docs, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out")).collect()
    assert len(back) == 30 and all(r[name] == r.doc_id * 100 + i for r in back for i, name in enumerate(names))
    for taken in ("shard", "SLOT"):
        with pytest.raises(ValueError, match="already"):
            sharding.shard(docs.withColumn(taken, docs.doc_id))
