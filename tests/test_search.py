import numpy as np
import pytest
from pyspark.sql import functions as F

from inkstrata.functions import vectors as vx
from inkstrata.operators import answering, search
from inkstrata.operators.chunking import Chunker
from inkstrata.operators.ingest import ingest
from inkstrata.plans import jobs
from inkstrata.sources import files


def brute_force(queries, corpus, k, metric):
    """Hits by comparing everything: score, then the larger id."""
    hits = {}
    for q, v in queries.items():
        scored = []
        for i, w in corpus.items():
            a, b = np.array(v), np.array(w)
            if metric == "cosine":
                a, b = a / (np.linalg.norm(a) or 1.0), b / (np.linalg.norm(b) or 1.0)
            scored.append((round(float(a @ b), 6), i))
        hits[q] = [i for _, i in sorted(scored, reverse=True)[:k]]
    return hits


@pytest.mark.parametrize("metric", ["cosine", "ip"])
@pytest.mark.parametrize("limit", [search.BROADCAST_NUMBERS, 8])
def test_top_k_against_brute_force(spark, metric, limit):
    rng = np.random.default_rng(5)
    # small whole numbers, so that there are many ties
    corpus = {i: rng.integers(0, 3, 4).astype(float).tolist() for i in range(300)}
    queries = {q: rng.integers(0, 3, 4).astype(float).tolist() for q in range(9)}
    stored = spark.createDataFrame(list(corpus.items()), "chunk_id bigint, embedding array<double>").repartition(5)
    asked = spark.createDataFrame(list(queries.items()), "query_id bigint, embedding array<double>")
    for k in (1, 7, 1000):
        got = search.top_k(asked, stored, k, 4, metric=metric, digits=6, broadcast_numbers=limit).collect()
        found = {}
        for r in sorted(got, key=lambda r: r["rank"]):
            found.setdefault(r["query_id"], []).append(r["chunk_id"])
        assert found == brute_force(queries, corpus, k, metric)


@pytest.mark.parametrize("limit", [search.BROADCAST_NUMBERS, 40])
def test_copies_rank_by_position_without_rounding(spark, limit):
    """A third of the vectors are one and the same; their scores must be equal bit by bit."""
    rng = np.random.default_rng(6)
    copied = rng.normal(size=37).tolist()
    corpus = {i: copied if i % 3 == 0 else rng.normal(size=37).tolist() for i in range(600)}
    queries = {0: [x * 0.7 for x in copied], 1: rng.normal(size=37).tolist()}
    stored = spark.createDataFrame(list(corpus.items()), "chunk_id bigint, embedding array<double>").repartition(3)
    asked = spark.createDataFrame(list(queries.items()), "query_id bigint, embedding array<double>")
    got = search.top_k(asked, stored, 50, 37, broadcast_numbers=limit).where("query_id = 0").orderBy("rank").collect()
    assert [r["chunk_id"] for r in got] == [i for i in range(599, -1, -1) if i % 3 == 0][:50]
    assert len({r["score"] for r in got}) == 1


def test_vectors_are_checked(spark):
    one = spark.createDataFrame([(1, [1.0, 2.0])], "chunk_id bigint, embedding array<double>")
    asked = one.withColumnRenamed("chunk_id", "query_id")
    with pytest.raises(ValueError):
        search.top_k(asked, one, 1, 2, metric="l2")
    with pytest.raises(ValueError):
        search.top_k(asked, one, 1, 3).collect()
    with pytest.raises(Exception, match="dimension mismatch"):
        search.top_k(asked.select("query_id", F.array(F.lit(1.0)).alias("embedding")), one, 1, 1).collect()
    with pytest.raises(Exception, match="dimension mismatch"):
        one.select(vx.checked(F.col("embedding"), 3)).collect()


def test_attached_hits_do_not_depend_on_the_way(spark, monkeypatch):
    hits = spark.createDataFrame([(q, 7 if q % 2 else q, 0.5, 1) for q in range(40)], "query_id int, chunk_id int, score double, rank int")
    store = spark.createDataFrame([(i, f"t{i}") for i in range(50)], "chunk_id int, content string")
    near = sorted(search.attach_hits(hits, store, ["chunk_id"]).select("query_id", "content").collect())
    monkeypatch.setattr(search, "BROADCAST_HITS", 0)
    assert sorted(search.attach_hits(hits, store, ["chunk_id"]).select("query_id", "content").collect()) == near


def test_digest_embedding(spark):
    import hashlib

    texts = ["", "a", "é😀"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for dim in (768, 40, 8):
        got = {r["t"]: r["v"] for r in rows.select("t", vx.digest_embedding(F.col("t"), dim).alias("v")).collect()}
        for t in texts:
            raw = (hashlib.sha256(t.encode()).digest() * 25)[:dim]
            norm = sum(float(b) ** 2 for b in raw) ** 0.5
            assert got[t] == [float(b) / norm for b in raw]


def test_zero_vectors_keep_their_length(spark):
    row = spark.range(1).select(
        vx.normalize(F.array(F.lit(0.0), F.lit(0.0))).alias("z"),
        vx.last_value(F.array(F.lit(1.0), F.lit(2.0)), F.array(F.lit(1), F.lit(0))).alias("unmasked"),
    ).first()
    assert row["z"] == [0.0, 0.0] and row["unmasked"] == 1.0


# The retrieval scenario.
KEYWORDS = ["security", "compliance", "pipeline"]


def keyword_counts(texts):
    return [[float(t.lower().count(k)) for k in KEYWORDS] for t in texts]


def test_ingest_then_ask(spark, tmp_path):
    """A small file is taken in and a question finds it."""
    doc = tmp_path / "security.md"
    doc.write_text("Security compliance pipeline\nThis line mentions security.")

    keywords = list(KEYWORDS)

    def encode(c):
        return answering.encode_with(lambda texts: [[float(t.lower().count(k)) for k in keywords] for t in texts], c)

    decoded = files.read_documents(spark, str(doc))
    index = ingest(decoded, Chunker(64, 8), encode, repo="test", commit="abc123")
    assert index.count() > 0
    index = index.select(
        F.lit(0).cast("bigint").alias("doc_id"), "chunk_index", "content", "embedding",
        *[F.col("metadata")[k].alias(k) for k in ("file_path", "repo", "commit", "source")],
    )
    asked = spark.createDataFrame([(1, "What does the security pipeline mention?")], "query_id bigint, question string")
    response = jobs.answer_from_index(asked, index, encode, 3, top_k=1).first()
    assert len(response["citations"]) == 1
    hit = response["citations"][0]
    assert hit["file_path"].endswith("security.md") and hit["commit"] == "abc123" and hit["label"] == "[1]"
    assert "[1] (" in response["prompt"] and response["answer"] == ""


def test_counts_agree_with_the_encoder(spark):
    texts = ["Security security", "", "pipelinepipeline", "COMPLIANCE é"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r["v"] for r in rows.select(vx.keyword_embedding(F.col("t"), KEYWORDS).alias("v")).collect()]
    assert got == keyword_counts(texts)
    with pytest.raises(ValueError):
        vx.keyword_embedding(F.col("t"), ["a", ""])


def test_questions_without_an_index(spark):
    asked = spark.createDataFrame([(1, "q")], "query_id bigint, question string")
    docs = spark.createDataFrame([], "doc_id bigint, text string, file_path string, commit string")
    got = jobs.answer_questions(asked, docs, Chunker(), lambda c: vx.keyword_embedding(c, KEYWORDS), 3).first()
    assert got["citations"] == [] and "No context available." in got["prompt"]


@pytest.mark.parametrize("bad", [float("nan"), float("inf")])
@pytest.mark.parametrize("side", ["query", "corpus"])
def test_vectors_must_be_finite(spark, bad, side):
    good = [(i, [float(i), 1.0]) for i in range(5)]
    worse = good[:3] + [(9, [bad, 1.0])]
    queries = spark.createDataFrame(worse if side == "query" else good, "query_id bigint, embedding array<double>")
    corpus = spark.createDataFrame(good if side == "query" else worse, "chunk_id bigint, embedding array<double>")
    with pytest.raises(Exception, match="not finite"):
        search.top_k(queries, corpus, 2, 2).collect()


def test_blocks_of_queries_shuffle_no_vectors(spark):
    rows = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(50)], "chunk_id bigint, embedding array<double>")
    queries = rows.withColumnRenamed("chunk_id", "query_id")
    whole = search.top_k(queries, rows, 3, 2).orderBy("query_id", "rank").collect()
    parts = search.top_k(queries, rows, 3, 2, broadcast_numbers=20)
    assert parts.orderBy("query_id", "rank").collect() == whole
    assert "CoGroup" not in parts._jdf.queryExecution().toString()


@pytest.mark.parametrize("digits", [None, 6])
def test_bounds_skip_blocks_and_change_nothing(digits):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(40, 8))
    queries = centres[:12] + 0.05 * rng.normal(size=(12, 8))
    vectors = np.concatenate([c + 0.05 * rng.normal(size=(50, 8)) for c in centres])
    vectors[60] = vectors[10]
    vectors, queries = search._unit(vectors), search._unit(queries)
    best = search._Best(len(queries), 1, 5)
    for at in range(0, len(vectors), 50):
        best.add(0, queries, vectors[at : at + 50], np.arange(at, at + 50)[None], digits)
    assert best.skipped >= best.offered // 2
    for q, query in enumerate(queries):
        scores = (vectors * query).sum(axis=1)
        scores = scores if digits is None else np.round(scores, digits)
        want = sorted(range(len(vectors)), key=lambda i: (-scores[i], -i))[:5]
        assert best.positions[0, q].tolist() == want and best.scores[q].tolist() == scores[want].tolist()
