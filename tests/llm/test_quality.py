import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from inkstrata.llm import quality
from tests.llm.helpers import documents, odd


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    runs = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(runs)
    covered = {i + k for i, r in enumerate(runs) if times[r] > 1 for k in range(3)}
    dup = sum(line in lines[:i] for i, line in enumerate(lines))
    return sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab é\n\t#|\x1c\xa0"), max_size=80))
def test_counts(text):
    assert quality.counts(text, quality.words_of(text)) == brute(text)


def labelled(spark, labels):
    return spark.createDataFrame(labels, "doc_id bigint, quality int")


def corpus():
    rng = random.Random(4)
    good = ["the quick house and many other words of a plain text that goes on".split()[rng.randrange(14)] for _ in range(5000)]
    texts, labels = [], []
    for i in range(400):
        own = [rng.choice(good) + str(rng.randrange(50)) for _ in range(80)]
        bad = i % 4 == 0
        texts.append((i + 10, "*** ".join(own) if bad else " ".join(own)))
        labels.append((i + 10, 0 if bad else 1))
    return texts, labels


def test_the_classifier_tells_unseen_rows(spark):
    texts, labels = corpus()
    seen = [x for x in labels if x[0] % 3]
    rows = {r.doc_id: r for r in quality.judge(documents(spark, texts), labelled(spark, seen + [(11, None), (None, 1), (12, 1)])).collect()}
    unseen = [x for x in labels if x[0] % 3 == 0]
    assert sum(rows[i].kept == bool(good) for i, good in unseen) >= 0.97 * len(unseen)
    assert all(0 <= r.quality <= 1 for r in rows.values())


def test_odd_rows_without_labels(spark):
    rows = quality.judge(documents(spark, odd()), labelled(spark, [])).collect()
    assert len(rows) == len(odd())
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].n_words == 0 and by_id[1].base_failed and not by_id[1].kept and by_id[1].quality is None
    assert by_id[3].n_words == 60_000 and by_id[3].n_repeat_words == 60_000 and by_id[3].base_failed
    assert quality.judge(documents(spark, []), labelled(spark, [(1, 1)])).count() == 0


def test_the_score_is_that_of_the_plain_formula(spark):
    texts, labels = corpus()
    docs, marks = documents(spark, texts + [(1, None), (2, "few words")]), labelled(spark, labels)
    model = quality.fit(docs, marks)
    for r in quality.judge(docs, marks, keep=("doc_id", "text")).collect():
        words = quality.words_of(r.text or "")
        w, c = quality.hashed((r.text or "").encode(), words)
        z = model.slope * (np.sum(model.words[w]) / len(w) + np.sum(model.chars[c]) / len(c)) + model.offset if words else -np.inf
        want = 1 / (1 + np.exp(-z))
        assert r.quality == pytest.approx(want, abs=2e-3)
        failed = len(words) < 50 or 2 * brute(r.text or "")[3] > len(words)
        assert r.base_failed == failed and (abs(want - 0.5) < 5e-3 or r.kept == (not failed and want >= 0.5))


def test_one_row_for_each_labelled_id(spark):
    texts, labels = corpus()
    once = quality.fit(documents(spark, texts), labelled(spark, labels))
    often = quality.fit(documents(spark, texts * 3), labelled(spark, labels))
    assert np.abs(once.words - often.words).max() < 1e-2 * np.abs(once.words).max()


def test_kept_columns_never_clash(spark):
    docs = documents(spark, odd()).withColumnRenamed("shard", "quality")
    assert quality.judge(docs, labelled(spark, [])).count() == len(odd())
    with pytest.raises(ValueError):
        quality.judge(docs, labelled(spark, []), keep=("doc_id", "quality"))
