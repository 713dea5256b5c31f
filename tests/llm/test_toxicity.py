import math
import random
import re

import pytest
from pyspark.sql import functions as F

from inkstrata.llm import toxicity
from tests.llm.helpers import documents, odd


def labelled(spark, labels):
    return spark.createDataFrame(labels, "doc_id bigint, toxic int")


def corpus():
    rng = random.Random(6)
    texts, labels = [], []
    for i in range(600):
        own = [f"w{rng.randrange(400)}" for _ in range(60)]
        bad = i % 5 == 0
        if bad:
            for word in rng.sample(["idiot", "scum", "moron", "zorblat", "zorblings", "zorbled"], 3):
                own[rng.randrange(60)] = word
        texts.append((i + 10, " ".join(own)))
        labels.append((i + 10, int(bad)))
    return texts, labels


def test_held_out_rows_are_told_and_their_labels_not_used(spark):
    texts, labels = corpus()
    docs = documents(spark, texts)
    rows = {r.doc_id: r for r in toxicity.report(docs, labelled(spark, labels + [(13, None), (None, 1), (14, 0)])).collect()}
    truth = dict(labels)
    held = [r for r in rows.values() if r.held_out]
    assert 60 < len(held) < 180
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in rows.values())
    hidden = {r.doc_id for r in held}
    other = [(i, 1 - x if i in hidden else x) for i, x in labels]
    again = {r.doc_id: r.score for r in toxicity.report(docs, labelled(spark, other)).collect()}
    assert again == {i: r.score for i, r in rows.items()}
    kept = toxicity.drop_toxic(docs, labelled(spark, labels))
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in rows.items() if r.predicted == 0}


def test_fold(spark):
    import zlib

    got = spark.range(50).select("id", toxicity.fold(F.col("id")).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 5 for r in got)


def test_features():
    learned = toxicity.Learned(["foo"], ["zorb"])
    found = dict(zip(toxicity.FEATURES, toxicity.features_of("You are an IDIOT, zorbling! 1d10t foo", learned)))
    assert round(found["lexicon_density"]) == round(100 / 7) and found["second_person_near"] == 2
    assert found["learned_hits"] > 1 and found["obfuscated_hits"] > 0 and found["exclamation_rate"] > 0
    assert toxicity.features_of(" \n", learned) == [0.0] * len(toxicity.FEATURES)


@pytest.mark.parametrize("word", ["1d10t", "$hit", "f***", "@sshole,", "(sh!t)", "!diot!", "M0R0N"])
def test_signs_for_letters(word):
    assert toxicity.unmasked(word, toxicity.Learned()) == (True, True)


@pytest.mark.parametrize("word", ["shit!", "*idiot*", "'loser'", "don't", "$5", "***", "2024", "", "--", "well-known"])
def test_signs_that_are_no_letters(word):
    assert toxicity.unmasked(word, toxicity.Learned()) == (False, False)


def test_unknown_words_with_signs():
    assert toxicity.unmasked("a$$", toxicity.Learned()) == (True, False)
    assert toxicity.unmasked("a$$", toxicity.Learned(["ass"])) == (True, True)
    assert toxicity.unmasked("zorb1ing", toxicity.Learned((), ["zorb"])) == (True, True)


def plain_features(text, learned):
    """The features, each by a count of its own."""
    raw = text.split()
    if not raw:
        return [0.0] * len(toxicity.FEATURES)
    edge = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum()) + "…“”‘’«»¡¿"
    words = []
    for word in raw:
        while word and word[0] in edge:
            word = word[1:]
        while word and word[-1] in edge:
            word = word[:-1]
        words.append(word.lower())
    taught = [w in learned.words or any(w.startswith(p) for p in learned.prefixes) for w in words]
    listed = [w in toxicity.LEXICON for w in words]
    near = 0
    for i in range(len(words)):
        around = words[max(0, i - 5) : i + 6]
        near += (taught[i] or listed[i]) and any(w in toxicity.SECOND_PERSON for w in around)
    size = len(text.encode())
    masks = [toxicity.unmasked(w, learned) for w in raw]
    runs = len(re.findall(r"([^\W\d_])\1\1", text))
    ascii_letters = sum(c.isascii() and c.isalpha() for c in text)
    capitals = sum("A" <= c <= "Z" for c in text)
    signs = sum(33 <= ord(c) < 127 and not c.isalnum() for c in text)
    n = len(words)
    return [
        100 * sum(listed) / n,
        math.log(1 + sum(listed)),
        100 * sum(taught) / n,
        math.log(1 + sum(taught)),
        100 * sum(w in toxicity.SECOND_PERSON for w in words) / n,
        near,
        capitals / max(1, ascii_letters),
        sum(w == w.upper() != w.lower() for w in raw) / n,
        100 * text.count("!") / size,
        100 * signs / size,
        100 * sum(m[0] for m in masks) / n,
        math.log(1 + sum(m[1] for m in masks)),
        100 * runs / n,
        math.log(n),
    ]


def test_features_against_plain_counts(spark, sf):
    learned = toxicity.Learned(["ther", "foo"], ["zorb", "clown"])
    rng = random.Random(3)
    pool = "You IDIOT $hit f*** a$$ zorblings! foo 'tu' Ärger!!! ÄÖÜ coool 12 1d10t -- the of YOUR, clowns 'u' ___".split()
    texts = [" ".join(rng.choices(pool, k=rng.randrange(1, 80))) for _ in range(200)]
    texts += ["", " \n", "many plain words " * 50 + "FOUR WORDS IN CAPITALS", "x" * 5000]
    texts += [r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    for text in texts:
        assert toxicity.features_of(text, learned) == pytest.approx(plain_features(text, learned)), text[:200]
    found = dict(zip(toxicity.FEATURES, toxicity.features_of("plain words " * 50 + "FOUR WORDS IN CAPITALS", learned)))
    assert found["capital_words"] == 4 / 104


def test_names_and_repeated_ids(spark):
    texts, labels = corpus()
    names = ["_toxicity_score", "_toxicity_margin", "_toxicity_features", "score", "c0", "a.b", "label", "part"]
    docs = documents(spark, texts + texts[:50])
    own = docs.withColumns({name: F.lit(name) for name in names})
    kept = toxicity.drop_toxic(own, labelled(spark, labels))
    assert kept.columns == own.columns
    rows = kept.collect()
    assert all(r[name] == name for r in rows[:5] for name in names)
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in toxicity.drop_toxic(docs, labelled(spark, labels)).collect())
    with pytest.raises(ValueError, match="column Score"):
        toxicity.scored(own, labelled(spark, labels), score="Score")


def test_odd_rows_and_few_labels(spark):
    rows = toxicity.report(documents(spark, odd()), labelled(spark, [])).collect()
    assert len(rows) == len(odd()) and all(r.score == 0 and r.predicted == 0 for r in rows)
    rows = toxicity.report(documents(spark, odd()), labelled(spark, [(2, 1), (4, 0)])).collect()
    assert len(rows) == len(odd())
    assert toxicity.report(documents(spark, []), labelled(spark, corpus()[1])).count() == 0
