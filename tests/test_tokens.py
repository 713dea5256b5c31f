import math
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from inkstrata.functions import tokens as tk
from inkstrata.operators import bpe, examples, unigram
from inkstrata.operators import vocabulary as vb


def merges_one_by_one(words, count):
    """Plain byte-pair learning: best pair, merge it everywhere, count again."""
    table = {tuple(w): n for w, n in words.items()}
    learnt = []
    while len(learnt) < count:
        pairs = Counter()
        for parts, n in table.items():
            for pair in zip(parts, parts[1:]):
                pairs[pair] += n
        pairs = {p: n for p, n in pairs.items() if n >= 2}
        if not pairs:
            break
        best, n = min(pairs.items(), key=lambda x: (-x[1], x[0]))
        learnt.append((*best, n))
        merged = Counter()
        for parts, k in table.items():
            out, i = [], 0
            while i < len(parts):
                if parts[i : i + 2] == best:
                    out.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            merged[tuple(out)] += k
        table = merged
    return learnt


def test_merges_equal_one_by_one_learning(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(12)
    words = vb.count_marked_words(docs)
    counted = {r["word"]: r["n"] for r in words.collect()}
    assert bpe.learn_merges(words, 40) == merges_one_by_one(counted, 40)


def test_merges_with_ties_and_repeats(spark):
    words = {"aaaa": 3, "abab": 5, "babb": 4, "cdcd": 5, "xyz": 7, "zzzzz": 2, "dcd": 4}
    df = spark.createDataFrame(list(words.items()), "word string, n bigint")
    for per_round in (1, 3, 32):
        assert bpe.learn_merges(df, 20, per_round) == merges_one_by_one(words, 20)


TEXTS = ["hello world 2024", " two  spaces\n\nlines ", "", "é😀 zzz", "x1y22"]


def plain(text):
    return " ".join(text.split())


def test_bpe_codec_gives_the_text_back(spark):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, text string")
    merges = bpe.learn_merges(vb.count_marked_words(rows), 10)
    letters = list("▁helowrd")
    pieces = {i: p for p, i in bpe.piece_ids(letters, merges).items()}
    for r in bpe.encode(rows, letters, merges).collect():
        assert bpe.decode(r["ids"], pieces) == plain(r["text"])


def test_unigram_codec_gives_the_text_back(spark):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS * 3)], "i int, text string")
    letters = sorted(set("".join("▁" + plain(t) for t in TEXTS)) - {" ", "😀"})
    model = unigram.learn_unigram(vb.count_marked_words(rows), letters, 40)
    assert len(model) <= 40 and set(letters) <= set(model)
    assert sum(math.exp(s) for s in model.values()) == pytest.approx(1.0)
    pieces = {i: p for p, i in unigram.piece_ids(model).items()}
    for r in unigram.encode(rows, model).collect():
        assert bpe.decode(r["ids"], pieces) == plain(r["text"])


def splits(word):
    if not word:
        yield []
    for i in range(1, len(word) + 1):
        for rest in splits(word[i:]):
            yield [word[:i], *rest]


def test_expected_pieces_against_all_splits():
    model = {"a": -1.0, "b": -2.0, "ab": -1.5, "ba": -2.5, "aba": -2.0}
    word = "abab"
    weights = [(s, math.exp(sum(model[p] for p in s))) for s in splits(word) if all(p in model for p in s)]
    total = sum(w for _, w in weights)
    want = Counter()
    for s, w in weights:
        for p in s:
            want[p] += w / total
    got = unigram.expected_pieces(word, model)
    assert {p: v for p, v in got.items() if v > 1e-12} == pytest.approx(dict(want))
    assert unigram.best_split(word, model)[1] == max(weights, key=lambda x: x[1])[0]


def test_alphabet_and_fallback(spark):
    counts = spark.createDataFrame([("a", 90), ("b", 9), ("é", 1)], "ch string, n bigint")
    kept = vb.alphabet(counts, 0.95)
    assert {r["ch"] for r in kept.collect()} == {"a", "b"}
    got = {r["ch"]: r["pieces"] for r in vb.byte_fallback(counts, kept).collect()}
    assert got == {"a": ["a"], "b": ["b"], "é": ["<0xC3>", "<0xA9>"]}


def test_word_codec(spark):
    rows = spark.createDataFrame([(1, "b a b c"), (2, ""), (3, "a"), (4, "9a9")], "i int, text string")
    vocabulary = vb.frequency_vocabulary(vb.count_words(rows), 7)
    assert {r["piece"]: r["id"] for r in vocabulary.collect()} == {
        "<pad>": 0, "<unk>": 1, "<s>": 2, "</s>": 3, "a": 4, "9": 5, "b": 6,
    }
    got = {r["i"]: r["ids"] for r in vb.encode_words(rows, vocabulary, "i").collect()}
    assert got == {1: [6, 4, 6, 1], 2: [], 3: [4], 4: [5, 4, 5]}
    short = {r["i"]: r["ids"] for r in vb.encode_words(rows, vocabulary, "i", limit=2).collect()}
    assert short == {1: [6, 4], 2: [], 3: [4], 4: [5, 4]}


def test_special_ids():
    assert tk.resolve_special_ids(-1, -1) == (0, 0)
    assert tk.resolve_special_ids(3, -1) == (3, 3)
    assert tk.resolve_special_ids(-1, 2) == (0, 2)


def test_examples_are_always_of_one_length(spark):
    rows = spark.createDataFrame([(i, list(range(10, 10 + i))) for i in range(6)], "i int, ids array<int>")
    got = examples.with_targets(examples.fixed_examples(rows, 4, 0, 2), 0).orderBy("i").collect()
    assert [r["input_ids"] for r in got] == [
        [2, 0, 0, 0], [2, 10, 0, 0], [2, 10, 11, 0], [2, 10, 11, 12], [2, 10, 11, 12], [2, 10, 11, 12],
    ]
    assert [sum(r["attention_mask"]) for r in got] == [1, 2, 3, 4, 4, 4]
    assert got[2]["labels"] == [10, 11, 0] and got[2]["counted_labels"] == 2


def test_batches_and_padding(spark):
    rows = spark.createDataFrame([(i, [1] * (i + 1)) for i in range(5)], "i int, ids array<int>")
    batched = examples.assign_batches(rows, 2, ["i"])
    padded = examples.dynamic_padding(batched, 3).orderBy("i").collect()
    assert [r["input_ids"] for r in padded] == [[1, 0], [1, 1], [1, 1, 1], [1, 1, 1], [1, 1, 1]]
    lists = examples.collect_batches(batched, "i").orderBy("batch_id").collect()
    assert [r["i"] for r in lists] == [[0, 1], [2, 3], [4]]
    assert examples.limit_batches(batched, 1).count() == 4
    assert examples.limit_batches(batched.withColumn("x", F.lit(1)), 9).count() == 5


def test_catalogue_queries_run_at_the_reference_sizes(spark, sf):
    from inkstrata.catalog import QUERIES

    examples_made = QUERIES["n4_training_examples"](spark, sf).select(F.size(F.split("input_ids", " ")).alias("n"))
    assert {r["n"] for r in examples_made.distinct().collect()} == {2048}
    # all words of the smallest table are in a vocabulary of 65 536
    unknown = QUERIES["j7_encode_words"](spark, sf).where(F.array_contains(F.split("ids", " "), "1"))
    assert unknown.count() == 0
    # special and byte pieces come on top; pieces that no split needs are gone
    assert 65_000 < QUERIES["j6_unigram_vocabulary"](spark, sf).count() <= 65_536 - 4 - 256


def test_lookups_take_bounded_parts():
    lists = [["word"] * (i % 7) for i in range(1000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(1000)), pa.array(lists)], names=["key", "words"])
    parts = list(vb.bounded_parts(batch, 4096))
    assert max(part.nbytes for part in parts) < 2 * 4096 < batch.nbytes
    assert pa.Table.from_batches(parts).to_pylist() == batch.to_pylist()
    assert [part.num_rows for part in vb.bounded_parts(batch.slice(0, 3), 1)] == [1, 1, 1]
    assert not list(vb.bounded_parts(batch.slice(0, 0)))
