import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import types as T

from inkstrata.llm import lexical
from tests.llm.helpers import documents, odd

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def brute(texts, items, top=10):
    """Every item against every document, as the contract has it."""
    own = [(i, Counter(terms(t))) for i, t in texts]
    own = [(i, c, sum(c.values())) for i, c in own if c]
    total, every = len(own), sum(n for _, _, n in own)
    df = Counter(t for _, c, _ in own for t in c)
    asked = defaultdict(Counter)
    for item, text in items:
        asked[item].update(terms(text))
    out = []
    for item, wanted in asked.items():
        hits = []
        for doc, counts, n in own:
            m = 100 - 75 + (75 * n * total) // every
            score = 0
            for term, times in wanted.items():
                if tf := counts[term]:
                    w = math.floor(1000 * math.log((2 * total + 2) / (2 * df[term] + 1)))
                    score += times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                hits.append((-score, doc is None, doc or 0))
        out += [(item, rank, None if none else doc, -score) for rank, (score, none, doc) in enumerate(sorted(hits)[:top], 1)]
    return sorted(out, key=str)


def items_of(spark, rows):
    return spark.createDataFrame(rows, T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())]))


TEXTS = odd(
    (7, "The cat, the CAT and the hat"),
    (8, "cat"),
    (9, "hat cat\thatcat cat-hat ÄRGER Ärger ärger 12"),
    (10, "İstanbul ſtraße word 12 12 twice"),
    *[(100 + i, f"copy of the same page {i % 2}") for i in range(40)],
)
ITEMS = [(1, "the cat the same"), (2, "Ärger ARGER 12 word"), (3, ""), (4, None), (None, "twice page"), (1, "hat"), (6, "nowhere"), (7, "ſtraße İSTANBUL")]


@pytest.mark.parametrize("bytes_", [lexical.GROUP_BYTES, 12])
def test_ranks_are_those_of_brute_force(spark, monkeypatch, bytes_):
    monkeypatch.setattr(lexical, "GROUP_BYTES", bytes_)
    got = lexical.rank_documents(documents(spark, TEXTS, 5), items_of(spark, ITEMS)).collect()
    assert sorted(map(tuple, got), key=str) == brute(TEXTS, ITEMS)


def test_small_blocks_give_the_same(spark):
    texts = [(i, f"w{i % 7} w{i % 3} w{i % 11} " * (1 + i % 4)) for i in range(300)]
    items = [(i, f"w{i} w{i + 1} w{i + 1}") for i in range(12)]
    rows = [(i, t.encode(), n) for i, text in items for t, n in Counter(terms(text)).items()]
    machine = lexical.Matcher(rows)
    whole = [machine.counts(t) for _, t in texts]
    assert [n for n, _ in whole] == [len(terms(t)) for _, t in texts]
    held = lexical._Best(machine.items, 3, lexical.pa.int64())
    held.add(lexical.pa.array([5, 4, 3, None, 9]), lexical.np.array([[2] * 12] * 3 + [[2] * 12] + [[3] * 12]))
    best = held.cut().to_pydict()
    assert best["doc_id"][:3] == [9, 3, 4] and best["score"][:3] == [3, 2, 2]
    held.add(lexical.pa.array([1]), lexical.np.array([[2] * 12]))
    assert held.cut().to_pydict()["doc_id"][:3] == [9, 1, 3]
    got = lexical.rank_documents(documents(spark, texts, 4), items_of(spark, items)).collect()
    assert sorted(map(tuple, got), key=str) == brute(texts, items)


def test_shares_are_added_in_parts(monkeypatch):
    rows = [(i, f"t{t}".encode(), 1 + (i + t) % 3) for i in range(20) for t in range(9) if (i * t) % 4 != 1]
    machine = lexical.Matcher(rows)
    of = lexical.np.repeat(lexical.np.arange(5), 9)
    term = lexical.np.tile(lexical.np.arange(9), 5)
    share = lexical.np.arange(45) * 10**12
    whole = machine.scores(5, of, term, share)
    monkeypatch.setattr(lexical, "BLOCK_SHARES", 7)
    assert (machine.scores(5, of, term, share) == whole).all() and whole.max() > 10**12


def test_empty_tables(spark):
    assert lexical.rank_documents(documents(spark, []), items_of(spark, ITEMS)).collect() == []
    assert lexical.rank_documents(documents(spark, [(1, None), (2, "-")]), items_of(spark, ITEMS)).collect() == []
    empty = lexical.rank_documents(documents(spark, TEXTS), items_of(spark, []))
    assert empty.collect() == [] and empty.columns == ["item_id", "rank", "doc_id", "score"]


def test_no_document_meets_another(spark):
    plan = lexical.rank_documents(documents(spark, TEXTS), items_of(spark, ITEMS))._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
