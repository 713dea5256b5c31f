import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from inkstrata.operators import bpe, codec, pairs, unigram
from inkstrata.operators import vocabulary as vb
from inkstrata.operators.lattice import MAX_PIECE, Lattice, Trie
from tests.test_tokens import merges_one_by_one, splits

PIECES = st.sets(st.text(alphabet="abcé", min_size=1, max_size=4), min_size=1, max_size=25)
WORDS = st.lists(st.text(alphabet="abcéx", max_size=9) | st.text(alphabet="abx", min_size=60, max_size=70), max_size=12)


def scored(pieces):
    # whole numbers of quarters, so that sums are exact and ties happen
    return {p: -1.0 - (sum(map(ord, p)) % 7) / 4 for p in sorted(pieces)}


@settings(max_examples=100, deadline=None)
@given(PIECES, WORDS)
def test_trie_holds_its_pieces_and_no_others(pieces, words):
    words = words + [""]
    ordered = sorted(pieces)
    trie = Trie(ordered)
    for word in [*ordered, *filter(None, words)]:
        state = np.zeros(1, np.int32)
        for c in word:
            number = trie.classes[min(ord(c), len(trie.classes) - 1)]
            state = trie.step(state, np.array([number])) if state[0] >= 0 else state
        found = trie.piece[state[0]] if state[0] >= 0 else -1
        assert found == (ordered.index(word) if word in pieces else -1)


@settings(max_examples=150, deadline=None)
@given(PIECES, WORDS)
def test_best_splits_and_counts_are_those_of_one_word_at_a_time(pieces, words):
    model = scored(pieces)
    lattice = Lattice(model)
    ids = bpe.piece_ids(list(model), [])
    assert unigram.coder(lattice, ids)(words) == [bpe.fall_back(unigram.best_split(w, model)[1], ids) for w in words]
    want = Counter()
    for w in words:
        for p, n in unigram.expected_pieces(w, model).items():
            want[p if p in model else None] += 3 * n
    got = lattice.expected(words, np.full(len(words), 3.0))
    assert got.tolist() == pytest.approx([want[p] for p in lattice.pieces] + [want[None]], abs=1e-9)
    for rows, scores, _ in lattice.best(words, whole=False):
        assert [scores[i] for i in range(len(rows))] == pytest.approx([unigram.best_split(words[r], model, without=words[r])[0] for r in rows])


def test_a_model_with_the_trie_of_a_larger_one():
    model = scored({"a", "b", "ab", "abb", "ba", "bba"})
    left = {p: s for p, s in model.items() if p not in ("ab", "ba")}
    one, two = Lattice(left), Lattice(left, list(model), Trie(list(model)))
    words = ["abbabab", "bab", "abx", "ab" * 40]
    for a, b in zip(one.best(words), two.best(words)):
        assert a[1].tolist() == b[1].tolist()
        names = [[x.pieces[i] if i < len(x.pieces) else "?" for i in row if i >= 0] for x, y in ((one, a), (two, b)) for row in y[2]]
        assert names[: len(names) // 2] == names[len(names) // 2 :]


def test_best_split_is_the_best_of_all():
    model = scored({"a", "b", "c", "ab", "ba", "abc", "cab", "aa", "bca"})
    for word in ("abcabca", "aabbcc", "bcabca", "c"):
        ways = [s for s in splits(word) if all(p in model for p in s)]
        top = max(sum(model[p] for p in s) for s in ways)
        ids = bpe.piece_ids(list(model), [])
        (own,) = unigram.coder(Lattice(model), ids)([word])
        names = {i: p for p, i in ids.items()}
        assert sum(model[names[i]] for i in own) == top and "".join(names[i] for i in own) == word


def test_vocabulary_has_the_size_asked_for(spark, sf):
    words = vb.count_marked_words(spark.read.parquet(f"{sf}/documents.parquet").limit(20))
    letters = sorted({c for r in words.collect() for c in r["word"]})
    model = unigram.learn_unigram(words, letters, 600)
    assert len(model) == 600 and set(letters) <= set(model)
    assert sum(math.exp(s) for s in model.values()) == pytest.approx(1.0)


@pytest.mark.parametrize("remembered", [codec.REMEMBERED, 2])
def test_ids_stay_with_their_rows(spark, monkeypatch, remembered):
    monkeypatch.setattr(codec, "REMEMBERED", remembered)
    rows = [(i, None if i % 5 == 0 else [f"w{i % 3}", "", "zz"][: i % 4]) for i in range(40)]
    df = spark.createDataFrame(rows, "i int, words array<string>").repartition(3)
    coded = codec.ids_column(lambda: lambda words: [[len(w)] * len(w) for w in words])
    for r in df.withColumn("ids", coded("words")).collect():
        assert r["ids"] == [len(w) for w in r["words"] or [] for _ in w]


def test_merges_with_few_known_pairs_and_rewritten_words(spark, monkeypatch):
    monkeypatch.setattr(pairs, "REBASE", 5)
    monkeypatch.setattr(pairs, "PART_WORDS", 40)
    rng = random.Random(5)
    words = {"".join(rng.choice("abcd") for _ in range(rng.randint(1, 9))): rng.randint(1, 6) for _ in range(120)}
    df = spark.createDataFrame(list(words.items()), "word string, n bigint")
    want = merges_one_by_one(words, 30)
    assert pairs.learn(bpe.start_symbols(df), 30, bpe.independent_prefix, 4, 2, known=6) == want


def test_queue_knows_what_it_does_not_know():
    queue = pairs.Queue([("a", "b", 9), ("c", "d", 7), ("e", "f", 5)], 2, 2, {"ab"})
    assert queue.first(5) == [("a", "b", 9), ("c", "d", 7)] and not queue.complete
    queue.made_symbol("ab")
    queue.made_symbol("cd")
    queue.change(("ab", "x"), 3)
    queue.change(("cd", "x"), 8)
    # the pair with the old symbol may be at 5 + 3 by now
    assert queue.first(5) == [("a", "b", 9)]
    queue.change(("a", "b"), -9)
    assert queue.first(5) == []


def test_seeds_are_the_best_substrings(spark):
    counts = {"▁transformation": 9, "▁transformer": 7, "▁a\x00😀bc": 3, "▁x": 1, "": 4, "▁" + "lo" * 30: 2, "formation": 5}
    words = spark.createDataFrame(list(counts.items()), "word string, n bigint").repartition(3)
    every = Counter()
    for word, n in counts.items():
        for i in range(len(word)):
            for j in range(i + 1, min(len(word), i + MAX_PIECE) + 1):
                every[word[i:j]] += n
    letters = sorted({c for w in counts for c in w} - {"x"})
    for size in (0, 1, 40, 10_000):
        best = sorted((p for p, n in every.items() if len(p) > 1 and n > 1), key=lambda p: (-every[p] * len(p), p.encode()))[:size]
        want = {p: every[p] for p in [*letters, *best] if set(p) <= set(letters)}
        total = math.log(sum(want.values()))
        got = unigram.seed_pieces(words, letters, size)
        assert got.keys() == want.keys()
        assert all(got[p] == pytest.approx(math.log(n) - total) for p, n in want.items())


def test_only_substrings_with_frequent_beginnings_are_counted(spark):
    words = spark.createDataFrame([("▁transformation", 9), ("▁translation", 7)], "word string, n bigint")
    begins = spark.sparkContext.broadcast(pa.array(["nsform"]))
    got = {r.piece: r.n for r in unigram._substrings(words, 7, 9, begins).collect()}
    assert got == {"nsforma": 9, "nsformat": 9, "nsformati": 9}
