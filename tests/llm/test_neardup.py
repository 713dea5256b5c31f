import random
import re

import numpy as np
import pytest

from inkstrata.llm import neardup
from inkstrata.llm import components
from inkstrata.llm.components import connected_components
from inkstrata.operators.skew import lookup_join
from tests.llm.helpers import documents, odd

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, size=2):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def brute(texts, size=2):
    """Component of each row by comparing all pairs."""
    sets = [shingle_set(t, size) for _, t in texts]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(texts))]


def edited(words, share, rng):
    out = list(words)
    for at in rng.sample(range(len(out)), max(1, int(share * len(out)))):
        out[at] = f"e{rng.randrange(10**6)}"
    return " ".join(out)


def corpus():
    rng = random.Random(5)
    texts = []
    for group in range(12):
        base = [f"g{group}w{rng.randrange(300)}" for _ in range(120)]
        texts += [" ".join(base)] * (group % 3)
        texts += [edited(base, share, rng) for share in (0.01, 0.02, 0.04, 0.05, 0.06, 0.08, 0.12)]
    # a large group with members that are edited too much for a link
    base = [f"h{rng.randrange(500)}" for _ in range(150)]
    texts += [edited(base, rng.choice([0.01, 0.02, 0.03, 0.055, 0.07, 0.1]), rng) for _ in range(150)]
    # a chain: each is near the next only
    chain = [f"c{i}" for i in range(200)]
    texts += [" ".join(chain[k * 18 :] + [f"x{k}y{i}" for i in range(k * 18)]) for k in range(6)]
    texts += ["one", "ONE", "One", "two words", "Two  WORDS", "É", "é"]
    return list(enumerate(texts, 100))


def check(spark, texts, size=2):
    got = neardup.near_duplicates(documents(spark, texts), size=size).collect()
    assert len(got) == len(texts)
    groups, ids = brute(texts, size), {}
    for (doc, _), group in zip(texts, groups):
        ids[group] = min(ids.get(group, doc), doc)
    want = {doc: (len(shingle_set(text, size)), ids[group]) for (doc, text), group in zip(texts, groups)}
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) == r.first for r in got)


def test_components_are_those_of_all_pairs(spark):
    check(spark, corpus())


def test_five_words(spark):
    check(spark, corpus()[:60], size=5)


def test_pairs_within_the_distance_share_a_file():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a = rng.integers(0, 1 << neardup.BITS, neardup.SYMBOLS).astype("<u2")
        b = a.copy()
        for at in rng.choice(neardup.SYMBOLS, 2 * neardup.CHUNKS - 1, replace=False):
            b[at] ^= 1
        import pyarrow as pa

        batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([a.tobytes(), b.tobytes()], pa.binary())], names=["node", "sig"])
        assert any(out.column(0)[0] == out.column(0)[1] for out in neardup._file(iter([batch])))


def test_odd_rows(spark):
    rows = neardup.near_duplicates(documents(spark, odd())).collect()
    assert len(rows) == len(odd())
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r)
    assert all(by_id[i][0].n_shingles == 0 and by_id[i][0].component_id == i and by_id[i][0].kept for i in (1, 2, 4))
    assert by_id[None][0].component_id is None and by_id[None][0].kept
    assert [r.kept for r in by_id[5]] == [True, True] and sum(r.first for r in by_id[5]) == 1
    assert by_id[6][0].component_id == 5 and not by_id[6][0].kept
    kept = neardup.drop_near_duplicates(documents(spark, odd()))
    assert kept.columns == documents(spark, []).columns
    assert sorted((r.doc_id is None, r.doc_id) for r in kept.collect()) == [(False, 1), (False, 2), (False, 3), (False, 4), (False, 5), (True, None)]


def test_empty_table_and_thresholds(spark):
    assert neardup.near_duplicates(documents(spark, [])).count() == 0
    assert neardup.drop_near_duplicates(documents(spark, [])).count() == 0
    with pytest.raises(ValueError):
        neardup.near_duplicates(documents(spark, []), threshold=50)


def test_connected_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)] + [(7, 7)]
    label = {n: n for pair in links for n in pair}
    for _ in range(len(label)):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {n: c for n, c in label.items() if any(n in pair and pair[0] != pair[1] for pair in links)}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_rounds_without_hot_keys_broadcast_nothing(spark, monkeypatch):
    calls = []

    def counted(*args, whole=components.join_totals):
        calls.append(args)
        return whole(*args)

    monkeypatch.setattr(components, "join_totals", counted)
    paths = spark.range(400).where("id % 4 < 3").selectExpr("id AS a", "id + 1 AS b")
    assert {(r.component, r["count"]) for r in connected_components(paths).groupBy("component").count().collect()} == {(i, 4) for i in range(0, 400, 4)}
    assert not calls
    star = spark.range(1, 200).selectExpr("id AS a", "0L AS b").unionByName(spark.createDataFrame([(199, 200)], "a bigint, b bigint"))
    assert {(r.component, r["count"]) for r in connected_components(star).groupBy("component").count().collect()} == {(0, 201)}
    assert calls


def test_lookups_without_hot_keys_broadcast_nothing(spark):
    facts = spark.createDataFrame([(i % 300, i) for i in range(600)] + [(None, 600)], "k int, row int")
    few = spark.createDataFrame([(k, -k) for k in range(299)], "k int, v int")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for how in ("inner", "left"):
            out = lookup_join(facts, few, ["k"], ["row"], how)
            assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
            expected = [(i % 300, i, -(i % 300) if i % 300 < 299 else None) for i in range(600)] + [(None, 600, None)]
            got = sorted(out.collect(), key=lambda r: r.row)
            assert [tuple(r) for r in got] == [r for r in expected if how == "left" or r[2] is not None]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
