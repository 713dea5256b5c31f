import random

import pytest
from pyspark.sql import functions as F

from inkstrata.operators import chunking, numbering, runlog, sinks, skew


def test_window_parameters():
    for size, overlap in ((0, 0), (5, -1), (5, 5)):
        with pytest.raises(ValueError):
            chunking.Chunker(size, overlap)


@pytest.mark.parametrize("size, overlap", [(800, 120), (64, 8), (5, 0), (5, 4), (1, 0)])
def test_chunks_rebuild_the_text(spark, size, overlap):
    texts = ["", "a", "x" * size, "y" * (size + 1), "é😀" * 41, "z" * (2 * size - overlap), " " * 7 + "\n"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    got = {}
    for r in chunking.chunk(rows, chunking.Chunker(size, overlap)).orderBy("i", "chunk_index").collect():
        got.setdefault(r["i"], []).append(r["content"])
    step = size - overlap
    for i, text in enumerate(texts):
        chunks = got.get(i, [])
        assert chunks == [
            text[s : s + size] for s in range(0, len(text), step) if s == 0 or s + overlap < len(text)
        ]
        assert "".join([c[:step] for c in chunks[:-1]] + chunks[-1:]) == text


def test_blank_chunks_leave_gaps(spark):
    rows = spark.createDataFrame([("ab" + " " * 6 + "cd",)], "text string")
    got = chunking.drop_blank(chunking.chunk(rows, chunking.Chunker(2, 0))).collect()
    assert [(r["chunk_index"], r["content"]) for r in got] == [(0, "ab"), (4, "cd")]


def numbered(spark, rows, schema, order, groups=(), buckets=7):
    df = spark.createDataFrame(rows, schema)
    got = numbering.number_rows(df, order, groups, buckets=buckets, start=0).collect()
    columns = [c.split()[0] for c in schema.split(", ")]
    want = {}
    for r in sorted(rows, key=lambda r: [r[columns.index(o)] for o in order]):
        key = tuple(r[columns.index(g)] for g in groups)
        want.setdefault(key, []).append(r)
    assert len(got) == len(rows)
    for r in got:
        key = tuple(r[g] for g in groups)
        assert want[key][r["row_number"]] == tuple(r[c] for c in columns)


def test_numbers_are_consecutive_per_group(spark):
    rng = random.Random(1)
    rows = [(rng.choice("aaab"), i) for i in rng.sample(range(10_000), 500)]
    numbered(spark, rows, "g string, id bigint", ["id"], ["g"])
    numbered(spark, rows, "g string, id bigint", ["id"])
    numbered(spark, rows, "g string, id bigint", ["g", "id"])


def test_numbers_with_one_hot_key(spark):
    rng = random.Random(2)
    rows = [(5 if i % 3 else rng.randrange(9), i) for i in rng.sample(range(900), 900)]
    df = spark.createDataFrame(rows, "k bigint, id bigint")
    numbered(spark, rows, "k bigint, id bigint", ["k", "id"])
    # the rows of the hot key do not share one bucket
    bucketed, levels = numbering._with_buckets(df, ["k", "id"], 8)
    largest = bucketed.groupBy(*levels).count().agg(F.max("count")).first()[0]
    assert levels == ["_bucket", "_inner"] and largest < 300


def test_numbers_of_nothing(spark):
    empty = spark.createDataFrame([], "id bigint")
    assert numbering.number_rows(empty, ["id"]).collect() == []


@pytest.mark.parametrize("window, block", [(1, 10), (4, 4), (25, 30), (25, 10_000)])
def test_rolling_mean(spark, window, block):
    rng = random.Random(3)
    values = {run: [rng.random() for _ in range(n)] for run, n in (("hot", 200), ("cold", 7))}
    rows = [(run, i, v) for run, vs in values.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "run string, step bigint, v double")
    got = numbering.rolling_mean(df, "v", "step", window, ("run",), block=block).collect()
    assert len(got) == len(rows)
    for r in got:
        frame = values[r["run"]][max(0, r["step"] - window + 1) : r["step"] + 1]
        assert r["rolling_mean"] == pytest.approx(sum(frame) / len(frame))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_join_with_hot_and_missing_keys(spark, how):
    rng = random.Random(4)
    facts = [("hot" if i % 2 else None if i % 10 == 0 else f"k{rng.randrange(400)}", i) for i in range(1500)]
    dim = [("hot", -1)] + [(f"k{i}", i) for i in range(0, 400, 2)]
    left = spark.createDataFrame(facts, "k string, i int")
    right = spark.createDataFrame(dim, "k string, d int")
    got = sorted((r["i"], r["d"]) for r in skew.lookup_join(left, right, ["k"], ["i"], how).fillna(-9, ["d"]).collect())
    table = dict(dim)
    want = sorted((i, table.get(k, -9)) for k, i in facts if how == "left" or k in table)
    assert got == want


def test_hot_rows_are_spread(spark, monkeypatch):
    """A key with a third of the rows is cut to the share of a task."""
    facts = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("k"),
        F.col("id").alias("i"),
    )
    dim = facts.select("k").distinct().withColumn("d", F.lit(1))
    seen = {}

    def join(self, other, on=None, how=None):
        if on == ["k", "_salt"]:
            seen["largest"] = self.groupBy(*on).count().agg(F.max("count")).first()[0]
            seen["copies"] = other.count() - dim.count()
        return original(self, other, on, how)

    original = type(facts).join
    monkeypatch.setattr(type(facts), "join", join)
    assert skew.lookup_join(facts, dim, ["k"], ["i"]).count() == 9000
    tasks = skew.partitions(facts)
    assert seen["largest"] <= 1.5 * 9000 / tasks and seen["copies"] <= 2 * tasks


def test_versions(spark):
    rows = [("r", f"step-{n}") for n in (9, 10, 100, 2)] + [("r", "final"), ("s", "step-1")]
    df = spark.createDataFrame(rows, "run string, name string")
    kept = {(r["run"], r["name"]) for r in runlog.rotate_versions(df, 2).where("kept").collect()}
    assert kept == {("r", "step-10"), ("r", "step-100"), ("r", "final"), ("s", "step-1")}
    none = {r["name"] for r in runlog.rotate_versions(df, 0).where("kept").collect()}
    assert none == {"final"}


def test_exact_shards(spark, tmp_path):
    rows = spark.range(25).select(
        F.lit("d").alias("dataset"), F.when(F.col("id") < 20, "a").otherwise("b").alias("split"), "id"
    )
    root = str(tmp_path / "shards")
    sinks.write_exact_shards(sinks.assign_shards(rows, ["id"], 8), root)
    back = spark.read.parquet(root)
    sizes = {(r["split"], r["shard"]): r["count"] for r in back.groupBy("split", "shard").count().collect()}
    assert sizes == {
        ("a", "shard-00001"): 8, ("a", "shard-00002"): 8, ("a", "shard-00003"): 4, ("b", "shard-00001"): 5,
    }
    assert back.where("split = 'a' and shard = 'shard-00002'").agg(F.min("id"), F.max("id")).first() == (8, 15)


ORDERS = {
    "constant leading keys": lambda i: (0, "same", i),
    "long names": lambda i: (0, f"file:/data/part-{i % 7:09d}/{'x' * (i % 3)}", i),
    "names of two bytes": lambda i: (i % 2, chr(97 + i % 3), i),
    "one name mostly": lambda i: (1, "é" if i % 10 else f"n{i}", i),
    "zero bytes": lambda i: (1, "a\0" if i % 2 else "a", i),
}


@pytest.mark.parametrize("case", sorted(ORDERS))
def test_any_order_key_is_cut(spark, case):
    rows = [ORDERS[case](i) for i in range(3000)]
    df = spark.createDataFrame(random.Random(1).sample(rows, len(rows)), "a int, name string, id bigint")
    got = numbering.number_rows(df, ["a", "name", "id"], start=0, buckets=8)
    want = {row: i for i, row in enumerate(sorted(rows, key=lambda r: (r[0], r[1].encode(), r[2])))}
    assert {(r["a"], r["name"], r["id"]): r["row_number"] for r in got.collect()} == want
    if case != "zero bytes":
        cells, levels = numbering._with_buckets(df, ["a", "name", "id"], 8)
        assert cells.groupBy(*levels).count().agg(F.max("count")).first()[0] <= 3000 // 3


def test_names_lead_without_one_task(spark):
    df = spark.range(20_000).select(F.concat(F.lit("file:/x/part-"), F.lpad(F.col("id").cast("string"), 8, "0")).alias("name"))
    cells, levels = numbering._with_buckets(df, ["name"], 16)
    sizes = [r["count"] for r in cells.groupBy(*levels).count().collect()]
    assert len(sizes) >= 10 and max(sizes) < 4000
