import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from inkstrata.llm import decontamination as dc
from tests.llm.helpers import documents, odd

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def expected(text, items):
    own, hit, found = words(text), set(), set()
    for item, data in items:
        w = words(data)
        k = min(13, len(w))
        windows = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if k else set()
        for at in range(len(own) - k + 1 if k else 0):
            if tuple(own[at : at + k]) in windows:
                hit.update(range(at, at + k))
                found.add("" if item is None else str(item))
    listed = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(own), len(hit), len(found), listed, bool(hit) and 20 * len(hit) >= len(own)


def cases():
    rng = random.Random(3)
    items = [(i, " ".join(rng.choice("ab cd efg hijk é x1").strip() or "w" for _ in range(rng.randrange(5, 40)))) for i in range(20)]
    items += [(20, "Solo"), (21, "two, Words!"), (22, None), (23, "..."), (24, items[3][1]), (None, "a null id here"), (100, items[4][1] + " tail")]
    texts = []
    for i in range(60):
        parts = [" ".join(rng.choice(["solo", "ab", "two", "words", "zz", "yy"]) for _ in range(rng.randrange(40)))]
        if i % 2:
            source = rng.choice(items)[1] or ""
            cut = rng.randrange(0, max(1, len(source) // 2))
            parts += [source[cut:].upper(), "End. é"]
        texts.append((10 + i, " \t".join(parts)))
    texts.append((90, "A null-ID\nHERE!"))
    return texts, items


@pytest.mark.parametrize("size", [8 << 20, 3000])
def test_hits_are_those_of_all_windows(spark, monkeypatch, size):
    monkeypatch.setattr(dc, "GROUP_BYTES", size)
    texts, items = cases()
    texts = odd(*texts)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = sorted(tuple(r) for r in dc.report(documents(spark, texts), bench).where("doc_id is not null").collect())
    want = sorted((doc, *expected(text, items)) for doc, text in texts if doc is not None)
    assert got == want
    kept = dc.drop_contaminated(documents(spark, texts), bench)
    assert kept.columns == documents(spark, []).columns
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == [w[0] for w in want if not w[-1]]


@settings(max_examples=200, deadline=None)
@given(st.text("ab ", max_size=60), st.lists(st.text("ab ", min_size=1, max_size=12), min_size=1, max_size=6))
def test_search_finds_every_occurrence(text, strings):
    data, wanted = text.encode(), sorted({s.encode() for s in strings})
    found = sorted(dc.WuManber(wanted).find(data))
    assert found == sorted((i, s) for s in wanted for i in range(len(data)) if data.startswith(s, i))


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    rows = dc.report(documents(spark, odd()), none).collect()
    assert len(rows) == len(odd()) and not any(r.contaminated for r in rows)
    assert dc.report(documents(spark, []), spark.createDataFrame([(1, "a b")], "item_id bigint, text string")).count() == 0


@pytest.mark.parametrize("size", [8 << 20, 3000])
def test_columns_of_any_names(spark, monkeypatch, size):
    monkeypatch.setattr(dc, "GROUP_BYTES", size)
    texts, items = cases()
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    docs = documents(spark, texts).selectExpr("doc_id AS row", "text", "shard AS _decontam_words", "lang AS hit", "source AS c0")
    kept = dc.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    want = sorted((doc, text, "own", "en", "s") for doc, text in texts if not expected(text, items)[-1])
    assert sorted(tuple(r) for r in kept.collect()) == want
    with pytest.raises(ValueError):
        dc.find_contamination(docs, bench)
