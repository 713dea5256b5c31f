import hashlib
import mmap
import string

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from inkstrata.llm import transducer
from inkstrata.llm.pieces import Pieces
from tests.llm.helpers import documents, odd

NAME = "word_bpe_49k.json"
PATH = public_tokenizers.path(NAME)
PLAIN = Tokenizer.from_file(PATH)
ENCODER = transducer.Encoder(PATH, None)
MERGES, DECODER = ENCODER.merges, transducer.Decoder(ENCODER.pieces.file)
WORDS = [w.encode() for w in ("", "a", "ab", "abs", "tops", "taps", "tap", "top", "ärger", "12", "stop", "stops", "tapstops")][1:]
ODD = st.text(alphabet=st.sampled_from("aBé'stÉÀ ½²,.<|>\n\x1c 0İſKΣσ😀ª中́ ­א"), max_size=40)
SPECIAL = st.sampled_from(["", "<|endoftext|>", "<|startoftext|>", "<|endoftext", "<|ENDOFTEXT|>", " <|endoftext|> don't"])


def held(tmp_path, words):
    path = tmp_path / "lexicon"
    path.write_bytes(transducer.compile_lexicon([(w, np.array([i, i + 1][: 1 + i % 2], "<u4").tobytes()) for i, w in enumerate(words)]))
    return transducer.Lexicon(str(path))


def test_lexicon_holds_its_words_and_no_others(tmp_path):
    lexicon = held(tmp_path, WORDS)
    asked = [*WORDS, b"", b"t", b"tapsto", b"topss", b"absolute", b"\xc3", b"z" * 100, "ärge".encode()]
    places = lexicon.places(asked)
    assert sorted(places[: len(WORDS)]) == list(range(len(WORDS))) and set(places[len(WORDS) :]) == {-1}
    ids = [np.frombuffer(data, "<u4").tolist() for data in lexicon.ids_of(places[: len(WORDS)])]
    assert ids == [[i, i + 1][: 1 + i % 2] for i in range(len(WORDS))]


def test_automaton_is_minimal(tmp_path):
    """As many states as there are different sets of endings."""
    endings = {}
    prefixes = {w[:i] for w in WORDS for i in range(len(w) + 1)}
    for p in prefixes:
        endings[p] = frozenset(w[len(p) :] for w in WORDS if w.startswith(p))
    assert len(held(tmp_path, WORDS).finals) == len(set(endings.values()))


@settings(max_examples=50, deadline=None)
@given(st.sets(st.binary(min_size=1, max_size=6), max_size=60), st.lists(st.binary(max_size=7), max_size=20))
def test_lookups_are_those_of_a_table(tmp_path_factory, words, others):
    words = sorted(words)
    lexicon = held(tmp_path_factory.mktemp("lexicon"), words)
    assert lexicon.places(words + others).tolist() == [words.index(w) if w in words else -1 for w in words + others]


def test_lexicon_is_mapped(tmp_path):
    array = held(tmp_path, WORDS).keys
    while isinstance(array, np.ndarray):
        array = array.base
    assert isinstance(array, mmap.mmap)


@settings(max_examples=300, deadline=None)
@given(ODD, SPECIAL, ODD)
def test_ids_are_those_of_the_library(one, special, two):
    text = one + special + two
    (got,) = ENCODER.encode([text])
    ids = PLAIN.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(got, "<u4").tolist() == ids
    assert DECODER.decode(ids) == PLAIN.decode(ids, skip_special_tokens=False)


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet=string.ascii_lowercase + "éß", min_size=1, max_size=80))
def test_merges_of_long_words(word):
    ids = PLAIN.encode(word, add_special_tokens=False).ids
    assert MERGES.ids(word.encode()) == MERGES._long(MERGES._start(word.encode())) == ids
    cut = [word[: i + 1].encode() for i in range(len(word))]
    assert MERGES.all_ids(cut) == [np.array(MERGES.ids(c), "<u4").tobytes() for c in cut]


def test_a_very_long_piece():
    word = "thequickbrownfox" * 5000
    assert MERGES.ids(word.encode()) == PLAIN.encode(word, add_special_tokens=False).ids


def expected(text):
    ids = PLAIN.encode(text or "", add_special_tokens=False).ids
    decoded = PLAIN.decode(ids, skip_special_tokens=False)
    return len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), decoded))


@pytest.mark.parametrize("words", [0, 3, transducer.WORDS])
def test_report_is_that_of_the_library(spark, words):
    texts = odd((7, "Hello, wörld <|endoftext|>don't"), (8, "x " * 3000), (9, "中文 text İ"), *[(20 + i, f"the page {i}, the end's") for i in range(40)])
    got = transducer.report(documents(spark, texts), NAME, words).collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted(((i, *expected(t)) for i, t in texts), key=str)


def test_encode_and_decode_keep_all_columns(spark):
    docs = documents(spark, odd((7, "Hello there")))
    both = transducer.decode(transducer.encode(docs, PATH), PATH)
    assert both.columns == [*docs.columns, "ids", "decoded"]
    for r in both.collect():
        ids = PLAIN.encode(r.text or "", add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.decoded == PLAIN.decode(ids, skip_special_tokens=False)
    with pytest.raises(ValueError, match="shard"):
        transducer.encode(docs, PATH, out="shard")


def test_empty_table(spark):
    assert transducer.report(documents(spark, []), NAME).collect() == []


def test_frequent_words_stay_within_the_bound(spark):
    counts = spark.createDataFrame([(f"w{i}", i // 10 + 1) for i in range(500)] + [("x" * 65, 10**6)], "word string, n bigint")
    for bound in (0, 5, 77, 500, 1000):
        got = {r.word for r in transducer.frequent_words(counts, bound).collect()}
        assert len(got) <= bound and "x" * 65 not in got
        assert not got or min(int(w[1:]) // 10 for w in got) >= max((int(f"{i}") // 10 for i in range(500) if f"w{i}" not in got), default=0) - 1


@pytest.mark.parametrize("name", ["byte_bpe_50k.json"])
def test_other_kinds_of_files_are_an_error(name):
    with pytest.raises(ValueError, match="normalizer"):
        Pieces(public_tokenizers.path(name))


def test_registered_query_on_its_table(spark, sf):
    from inkstrata.llm.queries import QUERIES

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op13_bpe"](spark, sf).collect()}
    assert got == {i: expected(t) for i, t in texts.items()}
