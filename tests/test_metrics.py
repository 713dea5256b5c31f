import math
import re
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from inkstrata.functions import scores as sc
from inkstrata.functions import vectors as vx
from inkstrata.operators import bigrams, evaluation, governance
from inkstrata.plans import jobs


def test_pass_at_k_against_all_draws(spark):
    rows = [(n, c) for n in range(5, 9) for c in range(n + 1)]
    df = spark.createDataFrame(rows, "n bigint, c bigint")
    for k in (1, 5):
        got = {(r["n"], r["c"]): r["p"] for r in df.withColumn("p", sc.pass_at_k(F.col("n"), F.col("c"), k)).collect()}
        for n, c in rows:
            draws = list(combinations(range(n), k))
            assert got[n, c] == pytest.approx(sum(min(d) < c for d in draws) / len(draws))


def test_pass_at_k_needs_enough_samples(spark):
    rows = [("a", True), ("a", False), ("b", False)]
    report = evaluation.pass_at_k(spark.createDataFrame(rows, "task_id string, passed boolean")).first()
    assert report["pass_at_1"] == 0.25 and report["pass_at_5"] is None


def test_exact_match(spark):
    rows = [(" Yes ", ["no", "YES"]), ("maybe", []), ("é", ["É"])]
    df = spark.createDataFrame(rows, "prediction string, references array<string>")
    assert evaluation.exact_match(df).first()[0] == pytest.approx(2 / 3)
    assert evaluation.exact_match(df.limit(0)).first()[0] == 0.0


def test_qa_report_with_a_generator(spark):
    rows = [("q", "c", ["c"]), ("r", "d", None)]
    df = spark.createDataFrame(rows, "question string, context string, answers array<string>")
    report = jobs.qa_report(df, lambda prompt: prompt + " C \n")
    assert report.first()[0] == 0.5


def test_accuracy(spark):
    tasks = spark.createDataFrame([("a",), ("b",), ("c",)], "task_id string")
    tests = spark.createDataFrame([("a", True), ("a", False), ("b", True)], "task_id string, passed boolean")
    row = evaluation.accuracy(tasks, tests).first()
    assert (row["tasks"], row["passed"]) == (3, 2)
    assert [r["task_id"] for r in evaluation.unattempted(tasks, tests).collect()] == ["c"]


def test_perplexity_is_weighted(spark):
    df = spark.createDataFrame([(1.0, 1), (2.0, 3), (None, 9)], "loss double, n bigint")
    assert evaluation.perplexity(df).first()[0] == pytest.approx(math.exp(7 / 4))
    assert evaluation.perplexity(df.limit(0)).first()[0] == 1.0


@pytest.mark.parametrize("frequent", [0, 1, 2, 100])
def test_bigram_losses_against_a_dictionary(spark, frequent):
    texts = {1: "a b a b c", 2: "a", 3: "", 4: "b c 12", 5: f"a b {'y' * 70} b a b a b c", 6: None}
    rows = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    words = {i: t.replace("12", "1 2").split() for i, t in texts.items() if t is not None}
    vocabulary = {w for ws in words.values() for w in ws}
    pairs, history = {}, {}
    for ws in words.values():
        for a, b in zip(ws, ws[1:]):
            pairs[a, b] = pairs.get((a, b), 0) + 1
            history[a] = history.get(a, 0) + 1
    losses = evaluation.bigram_loss(rows, evaluation.learn_bigrams(rows), "doc_id", frequent=frequent)
    got = {r["doc_id"]: r for r in losses.collect()}
    assert len(got) == len(texts) and got[6]["loss"] is None
    for i, ws in words.items():
        terms = [-math.log((pairs[p] + 1) / (history[p[0]] + len(vocabulary))) for p in zip(ws, ws[1:])]
        assert got[i]["n"] == len(ws)
        assert got[i]["loss"] == (pytest.approx(sum(terms) / len(terms)) if terms else None)


@pytest.mark.parametrize("limit", [0, 1, 2, 3, 4, 6, 7, 100])
def test_frequent_pairs_are_bounded_and_whole(spark, limit):
    far = "z" * 40
    texts = ["a b " * 9, "c d " * 5, "e f", f"{far} {far} {far}"]
    model = evaluation.learn_bigrams(spark.createDataFrame([(t,) for t in texts], "text string"))
    counted = {(r.w1, r.w2): r.n for r in model.pairs.collect()}
    held, others = evaluation._split_by_frequency(model, limit)
    inside = {} if held is None else {(r.w1, r.w2): r.lp for r in held.collect()}
    outside = set() if others is None else {(r.w1, r.w2) for r in others.collect()}
    assert len(inside) <= limit and not inside.keys() & outside and inside.keys() | outside == counted.keys()
    assert (far, far) in outside and (limit < 5 or len(inside) == 5)
    least = min((counted[p] for p in inside), default=0)
    assert all(p == (far, far) or counted[p] <= least for p in outside) or not inside
    begins = {}
    for (first, _), n in counted.items():
        begins[first] = begins.get(first, 0) + n
    for pair, lp in inside.items():
        assert lp == pytest.approx(math.log((counted[pair] + 1) / (begins[pair[0]] + model.vocabulary)))


@pytest.mark.parametrize("small", [False, True])
def test_unseen_pairs_are_scored(spark, small):
    model = evaluation.learn_bigrams(spark.createDataFrame([("a b a b a b c",)], "text string"))
    rows = spark.createDataFrame([(1, "a b z q x"), (2, "z q x"), (3, "a b c c")], "doc_id bigint, text string")
    got = {r["doc_id"]: r["loss"] for r in evaluation.bigram_loss(rows, model, "doc_id", small=small).collect()}
    seen = {"ab": 4 / 6, "bz": 1 / 6, "zq": 1 / 3, "qx": 1 / 3, "bc": 2 / 6, "cc": 1 / 3}
    for doc, pairs in {1: ["ab", "bz", "zq", "qx"], 2: ["zq", "qx"], 3: ["ab", "bc", "cc"]}.items():
        assert got[doc] == pytest.approx(-sum(math.log(seen[p]) for p in pairs) / len(pairs))


def test_bigrams_meet_by_bucket(spark):
    rows = spark.createDataFrame([(i, f"a b c{i} 7d \tx\x0by\r" + "é ü " * i) for i in range(40)], "doc_id bigint, text string")
    model = evaluation.learn_bigrams(rows)
    # a pair is no row of its own in any shuffle
    losses = evaluation.bigram_loss(rows, model, "doc_id", frequent=2)
    assert "hashpartitioning(w1" not in losses._jdf.queryExecution().toString()
    assert model.counts.count() == model.buckets == 1
    words = [re.findall(r"[0-9]|[^0-9\t-\r ]+", r["text"]) for r in rows.collect()]
    want = Counter(p for ws in words for p in zip(ws, ws[1:]))
    assert {(r.w1, r.w2): r.n for r in model.pairs.collect()} == want


def test_bigrams_of_unnumbered_words(spark, monkeypatch):
    texts = ["a b zz a b", "zz a 1zz b", "b a", None, "  "]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")

    def losses():
        model = evaluation.learn_bigrams(rows)
        got = evaluation.bigram_loss(rows, model, "doc_id", frequent=1).collect()
        return {r.doc_id: (r.n, r.loss and round(r.loss, 9)) for r in got}, {(r.w1, r.w2): r.n for r in model.pairs.collect()}

    all_numbered = losses()
    # three words of four are strings; buckets are many
    monkeypatch.setattr(bigrams, "FREQUENT_WORDS", 1)
    monkeypatch.setattr(bigrams, "BUCKET_WORDS", 2)
    assert losses() == all_numbered


def test_log_softmax(spark):
    row = spark.range(1).select(vx.log_softmax(F.array(*[F.lit(float(x)) for x in (1000, 1001)])).alias("p")).first()
    assert sum(math.exp(p) for p in row["p"]) == pytest.approx(1.0)


def test_policy_loss(spark):
    rows = [(0, [0.0, 0.0], 1, 2.0, 1.0, 0.5), (0, [0.0, 0.0], 0, 3.0, 1.0, 0.5), (1, [0.0, 0.0], 0, 1.0, 1.0, None)]
    df = spark.createDataFrame(rows, "batch int, logits array<double>, action int, reward double, value double, kl double")
    want = (math.log(2) * 1.5 + 0.5 + 0.0) / 2
    assert evaluation.policy_loss(df).first()[0] == pytest.approx(want)


def test_schedule_and_progress(spark):
    row = spark.range(1).select(
        sc.warmup_then_decay(F.lit(0), 10, F.lit(100)).alias("first"),
        sc.warmup_then_decay(F.lit(55), 10, F.lit(100)).alias("half"),
        sc.warmup_then_decay(F.lit(500), 0, F.lit(100)).alias("after"),
        sc.eta_seconds(F.lit(2.0), F.lit(200), F.lit(100)).alias("eta"),
        sc.tokens_per_second(F.lit(8.0), F.lit(0.0)).alias("rate"),
    ).first()
    assert tuple(row) == (0.1, 0.5, 0.0, 0.0, 0.0)


def test_encryption_round_trip(spark):
    index = spark.createDataFrame([("text é", {"file_path": "a"})], "content string, metadata map<string,string>")
    old, new = b"k" * 32, b"n" * 32
    sealed = governance.encrypt_index(index, old)
    assert sealed.first()["content"] != b"text \xc3\xa9"
    again = governance.reencrypt_index(sealed, old, new)
    assert governance.decrypt_index(again, new).collect() == index.collect()
    with pytest.raises(Exception):
        governance.decrypt_index(again, old).collect()
    with pytest.raises(ValueError):
        governance.encrypt_index(index, b"short")


def test_no_plan_names_the_key(spark):
    key = b"0123456789abcdefFEDCBA9876543210"
    index = spark.createDataFrame([("t", {"file_path": "a"})], "content string, metadata map<string,string>")
    for df in (governance.encrypt_index(index, key), governance.reencrypt_index(governance.encrypt_index(index, key), key, key)):
        df.collect()
        plan = df._jdf.queryExecution()
        for text in (plan.toString(), plan.stringWithStats(), plan.executedPlan().toString()):
            assert key.decode() not in text and key.hex() not in text.lower()


def test_preference_scores_keep_every_pair(spark):
    rows = [
        (1, 0, "chosen", [0.0, 5.0]), (1, 0, "rejected", [1.0]), (1, 1, "chosen", [2.0]), (1, 1, "rejected", [9.0]),
        (2, 0, "chosen", [1.0, None]), (2, 0, "rejected", [3.0]), (3, 0, "chosen", [4.0]), (4, 0, "rejected", [4.0]),
    ]
    df = spark.createDataFrame(rows, "prompt_id bigint, draw int, kind string, values array<double>")
    got = evaluation.preference_scores(df, ["draw"]).collect()
    want = {(1, 0, 5.0, 1.0), (1, 1, 2.0, 9.0), (2, 0, None, 3.0)}
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    with pytest.raises(Exception, match="several rows of one kind"):
        evaluation.preference_scores(df).count()
