"""Work that has to stay in bounded parts as tables grow."""

import os

import pyarrow as pa
from pyspark.sql import functions as F

from inkstrata.catalog import QUERIES, governance as sealing, metrics, streams
from inkstrata.llm import neardup
from inkstrata.operators import bpe, governance, pairs
from inkstrata.operators import vocabulary as vb
from inkstrata.operators.ingest import apply_converters
from inkstrata.sources import tables


def files_in(folder):
    return [name for name in os.listdir(folder) if name.endswith(".parquet")]


def in_folder(monkeypatch, module, path):
    monkeypatch.setattr(module, "fresh_dir", lambda spark, label: f"{path}/{label}")


def test_a_folder_of_texts_is_written_by_several_tasks(spark, tmp_path, monkeypatch):
    in_folder(monkeypatch, metrics, tmp_path)
    rows = [(i, "ab"[i % 2], f"text {i} " * 50) for i in range(4000)]
    spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(tables, "SHARE_BYTES", 1000)
    found = {tuple(r) for r in QUERIES["h3_file_order"](spark, str(tmp_path)).collect()}
    assert found == {("a", 1, 2000), ("b", 2, 2000)}
    assert min(len(files_in(f"{tmp_path}/ordered/lang={lang}")) for lang in "ab") > 1


def test_deliveries_grow_with_the_table(spark, sf, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "DELIVERY_BYTES", 20_000)
    for name, batches in (("k1_stream_clean_and_shard", 2), ("k3_stream_index_append", 3)):
        in_folder(monkeypatch, streams, f"{tmp_path}/{name}")
        assert QUERIES[name](spark, sf).count() > 0
        stored = f"{tmp_path}/{name}/stream"
        # as many micro-batches as before, of more files
        assert len([b for b in os.listdir(f"{stored}/progress/commits") if b.isdigit()]) == batches
        assert len(files_in(f"{stored}/in")) == tables.deliveries(spark, f"{sf}/documents.parquet", 4 if batches == 2 else 3) > 10


def test_converters_keep_large_keys_and_places(spark):
    rows = spark.createDataFrame([("a.x", 2**53 + 1, "p,,q"), ("b.x", None, "r"), ("c.x", 3, ",")], "path string, id bigint, text string")
    split = {".x": lambda text: (part or None for part in text.split(","))}
    got = sorted(tuple(r) for r in apply_converters(rows.coalesce(1), split, keep=("path", "id")).collect())
    assert got == [("a.x", 2**53 + 1, 0, "p"), ("a.x", 2**53 + 1, 2, "q"), ("b.x", None, 0, "r")]


def test_converters_take_long_texts_in_parts(spark):
    # in pandas all pieces of an Arrow batch would be made at once
    rows = spark.range(3).select(F.concat(F.col("id"), F.lit(".x")).alias("path"), F.lit("t").alias("text"))
    plan = apply_converters(rows, {".x": list})._jdf.queryExecution().toString()
    assert "MapInArrow" in plan and "MapInPandas" not in plan


def test_only_rows_of_repeated_keys_are_compared_by_a_join(spark, tmp_path):
    def index(rows):
        plain = spark.createDataFrame(rows, "doc_id long, chunk_index int, content string")
        return plain.withColumn("metadata", F.create_map(F.lit("file_path"), F.col("content")))

    key = b"k" * 32
    for at, rows in enumerate(([(1, 0, "a"), (1, 1, "b"), (2, 0, "c")], [(1, 0, "a"), (1, 0, "b"), (2, 0, "c"), (None, 0, "d")])):
        governance.encrypt_index(index(rows), key).write.parquet(f"{tmp_path}/{at}")
        out = sealing.opened(None, spark.read.parquet(f"{tmp_path}/{at}"), key)
        # a null key met nothing in the join either
        want = [(*a, a[2], 1) for a in rows for b in rows if a[0] is not None and a[:2] == b[:2]]
        assert sorted(map(tuple, out.collect())) == sorted(want)
        assert at or "hashpartitioning" not in out._jdf.queryExecution().executedPlan().toString()


def test_words_are_counted_once_and_tasks_keep_nothing(spark):
    seen = spark.sparkContext.accumulator(0)

    def counting(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    words = {"abab": 5, "babb": 4, "cdcd": 5, "aaaaa": 2, "x": 9, "": 1, "é😀é😀": 3}
    rows = spark.createDataFrame(list(words.items()), "word string, n bigint").coalesce(1)
    learnt = bpe.learn_merges(rows.mapInArrow(counting, rows.schema), 6)
    assert learnt[:2] == [("a", "b", 14), ("c", "d", 10)] and len(learnt) == 6
    # the words were computed again for every use
    assert seen.value == len(words)


def test_a_merge_changes_the_pairs_around_it():
    batch = pa.RecordBatch.from_arrays([pa.array(["zz", "aaaab", "baa"]), pa.array([1, 5, 2])], names=["word", "n"]).slice(1)
    marked = [pairs.OPEN + (pairs.CLOSE + pairs.OPEN).join(w) + pairs.CLOSE for w in batch.column(0).to_pylist()]
    (numbered,) = pairs._numbered([pa.RecordBatch.from_arrays([pa.array(marked), batch.column(1)], names=["symbols", "n"])])
    words, names, sums = pairs.Words(numbered), pairs.Symbols(), pairs._Sums()
    (group,) = pairs.grouped([names.merge("a", "a")], list(names.made))
    sums.add(*words.merge(group))
    got = {(r["left"], r["right"]): r["n"] for b in sums.rows(list(names.made)) for r in b.to_pylist()}
    # aaaab: aa aa b; baa: b aa
    assert got == {("a", "a"): -17, ("a", "b"): -5, ("b", "a"): -2, ("aa", "aa"): 5, ("aa", "b"): 5, ("b", "aa"): 2}


def test_merges_that_meet_are_not_applied_at_once():
    names = pairs.Symbols()
    merges = [names.merge(*p) for p in (("a", "b"), ("a", "c"), ("c", "d"), ("x", "x"), ("e", "f"), ("ef", "g"))]
    assert [len(g) for g in pairs.in_groups(merges)] == [2, 1, 1, 1, 1]


def test_marked_words_of_distinct_texts(spark):
    texts = ["a1 a1 b22", "  \n", "", None, "x▁y 9", " a1 "]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    plain = rows.select(F.explode(vb.marked_words(F.col("text"))).alias("word")).groupBy("word").count()
    counted = vb.count_marked_words(rows)
    assert {tuple(r) for r in counted.collect()} == {tuple(r) for r in plain.collect()}
    # the text itself is only cut at white space
    assert vb.MARKED_BREAK in counted.select("word")._jdf.queryExecution().toString().split("Aggregate")[1]


def test_nodes_are_filed_in_small_tasks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "FILED_NODES", 10)
    file = neardup._file

    def bounded(batches):
        batches = list(batches)
        assert sum(b.num_rows for b in batches) <= 20
        yield from file(iter(batches))

    monkeypatch.setattr(neardup, "_file", bounded)
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(20))) for i in range(99)] + [(200, " ".join(f"w5x{j}" for j in range(20)))]
    found = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {(r["doc_id"], r["component_id"]) for r in found.collect() if not r["kept"]} == {(200, 5)}
