import hashlib
import zlib
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from inkstrata.llm import merkle
from tests.llm.helpers import documents, odd


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(nodes):
    """All levels of a tree, from its leaves to the one node that remains."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([H(*last[i : i + 3]) for i in range(0, len(last), 3)])
    return levels


def way(levels, pos):
    out = []
    for level in levels[:-1]:
        first = pos // 3 * 3
        out.append(("".join(level[first:pos]), "".join(level[pos + 1 : first + 3])))
        pos //= 3
    return out


def brute(rows):
    made = [(r, leaf(r, r["text"])) for r in rows]
    made.sort(key=lambda x: (x[0]["source"] is not None, (x[0]["source"] or "").encode(), x[0]["doc_id"] is not None, x[0]["doc_id"] or 0, x[1]))
    groups = [list(g) for _, g in groupby(made, key=lambda x: x[0]["source"])]
    trees = [tree([node for _, node in g]) for g in groups]
    top = tree([t[-1][0] for t in trees])
    out = []
    for spot, (own, levels) in enumerate(zip(groups, trees)):
        for pos, (row, node) in enumerate(own):
            path = way(levels, pos) + way(top, spot)
            start = node
            if row["doc_id"] is not None and row["text"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 2 == 0:
                start = leaf(row, row["text"].replace("\n", ""))
            for left, right in path:
                start = H(left, start, right)
            root = top[-1][0]
            out.append((row["doc_id"], node, levels[-1][0], root, H(*[a + b for a, b in path]), start, start == root))
    return sorted(out, key=str)


def sourced(spark, texts, source):
    return documents(spark, texts).withColumn("source", F.expr(source))


SOURCES = {
    "hot": "CASE WHEN doc_id % 7 = 0 THEN 'rare' WHEN doc_id % 11 = 0 THEN NULL WHEN doc_id = 13 THEN '' ELSE 'hot' END",
    "many": "concat('é', CAST(doc_id AS STRING))",
    "one": "'s'",
    "none": "CAST(NULL AS STRING)",
}


@pytest.mark.parametrize("source, rows", [("one", 1), ("none", 81), ("many", 82), ("hot", 250)])
def test_manifest_is_that_of_brute_force(spark, source, rows):
    texts = [(i, None if i % 13 == 5 else f"line {i}\n" * (i % 3)) for i in range(rows)]
    docs = sourced(spark, texts, SOURCES[source])
    assert sorted(map(tuple, merkle.report(docs).collect()), key=str) == brute([r.asDict() for r in docs.collect()])


def test_odd_rows_and_repeats(spark):
    docs = sourced(spark, odd(*[(9, "same\n")] * 90, (None, "no id\n")), "CASE WHEN doc_id = 2 THEN NULL ELSE 's' END")
    assert sorted(map(tuple, merkle.report(docs).collect()), key=str) == brute([r.asDict() for r in docs.collect()])


def test_ids_that_are_strings(spark):
    docs = documents(spark, [(i, f"t{i}\n") for i in (3, 20, 100, None)]).withColumn("doc_id", F.col("doc_id").cast("string"))
    rows = [r.asDict() for r in docs.collect()]
    got = merkle.manifest(docs).collect()
    ordered = sorted(rows, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or ""))
    subroot = tree([leaf(r, r["text"]) for r in ordered])[-1][0]
    assert {r.subroot for r in got} == {r.root for r in got} == {subroot}


def test_empty_table(spark):
    made = merkle.report(documents(spark, []))
    assert made.collect() == [] and made.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_only_expressions_and_no_text_above_the_leaves(spark):
    plan = merkle.report(documents(spark, odd()))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "text#"))
