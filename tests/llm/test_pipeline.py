"""The stages against plain statements of what they keep, on the smallest tables."""

import re

import corpus_pipeline
import pytest
from tests.llm import test_decontamination, test_neardup, test_packing, test_secrets
from tests.llm.helpers import documents, odd


@pytest.fixture(scope="module")
def results(spark, sf, tmp_path_factory):
    base = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), {}
    columns = docs.columns
    out["start"] = docs.collect()
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf).write.parquet(str(base / name))
        docs = spark.read.parquet(str(base / name))
        out[name] = docs.collect()
        assert name == "packing" or docs.columns == columns
    return out


def test_names():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "packing"]


def test_toxicity_keeps_rows_as_they_are(results):
    start = {r.doc_id: r for r in results["start"]}
    kept = results["toxicity"]
    assert 0.7 * len(start) < len(kept) <= len(start) and all(start[r.doc_id] == r for r in kept)


def test_one_of_each_group_stays(results):
    texts = [(r.doc_id, r.text) for r in results["toxicity"]]
    groups = {}
    for (doc, _), group in zip(texts, test_neardup.brute(texts)):
        groups[group] = min(groups.get(group, doc), doc)
    assert {r.doc_id for r in results["near_duplicates"]} == set(groups.values())


def test_contaminated_rows_go(results, spark, sf):
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    want = {r.doc_id for r in results["near_duplicates"] if not test_decontamination.expected(r.text, items)[-1]}
    assert {r.doc_id for r in results["decontamination"]} == want


def test_secrets_are_gone(results):
    before = {r.doc_id: r for r in results["decontamination"]}
    after = results["secrets"]
    assert len(after) == len(before)
    for r in after:
        assert not test_secrets.expected(r.text) and r.n_chars == len(r.text)
        if not test_secrets.expected(before[r.doc_id].text) and "[SECRET]" not in r.text:
            assert r == before[r.doc_id]
        assert re.sub(r"\[SECRET\]", "", r.text) == "" or r.text


def test_every_id_is_packed(results):
    want = {r.doc_id: len(test_packing.ids_of(r.text)) for r in results["secrets"]}
    got = {}
    for r in results["packing"]:
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
        assert r.doc_tokens == want[r.doc_id]
    assert got == want


def test_odd_rows_and_empty_tables_pass_all_stages(spark, sf, tmp_path):
    for label, texts in (("odd", odd()), ("empty", [])):
        docs = documents(spark, texts)
        for name, stage in corpus_pipeline.STAGES:
            stage(spark, docs, sf).write.parquet(str(tmp_path / f"{label}-{name}"))
            docs = spark.read.parquet(str(tmp_path / f"{label}-{name}"))
        assert (docs.count() > 0) == bool(texts)


def test_the_last_table_holds_the_ids(results):
    want = {r.doc_id: b"".join(int(i).to_bytes(4, "little") for i in test_packing.ids_of(r.text)) for r in results["secrets"]}
    got = {r.doc_id: b"" for r in results["secrets"]}
    for r in sorted(results["packing"], key=lambda r: (r.doc_id, r.start)):
        got[r.doc_id] += bytes(r.ids)
    assert got == want
