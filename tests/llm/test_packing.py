import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from inkstrata.llm import packing
from inkstrata.llm.common import hold
from inkstrata.llm.queries import TOKENIZER
from tests.llm.helpers import documents, odd

PLAIN = Tokenizer.from_file(TOKENIZER)


def ids_of(text):
    return np.asarray([*PLAIN.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("aBé'stÉÀ ½²,.<|>\n\x1c 0İſKΣσ😀ª中"), max_size=40))
def test_cached_ids_are_those_of_the_tokenizer(text):
    got = packing.CachedTokenizer(TOKENIZER).encode([text, "don't <|endoftext|> stop"])
    assert got[0] == ids_of(text)[:-1].tobytes()
    assert got[1] == ids_of("don't <|endoftext|> stop")[:-1].tobytes()


@pytest.mark.parametrize("name", ["byte_bpe_50k.json"])
def test_other_kinds_of_files(name):
    path = public_tokenizers.path(name)
    texts = ["hello world, a test of it", "", "  Ärger\n\n12 "]
    want = [np.asarray(Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]
    assert packing.CachedTokenizer(path).encode(texts) == want


def test_many_pieces_stay_apart():
    words = [f"w{i}x" for i in range(3000)]
    assert packing.CachedTokenizer(TOKENIZER).encode([" ".join(words)])[0] == ids_of(" ".join(words))[:-1].tobytes()


def test_remembered_pieces_take_bounded_memory(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_BYTES", 1 << 20, raising=False)
    tokenizer, sizes = packing.CachedTokenizer(TOKENIZER), []
    for n in range(30):
        # few pieces, long ones
        text = " ".join(chr(ord("a") + (n + i) % 26) * (2000 + 26 * n + i) for i in range(50))
        assert tokenizer.encode([text]) == [ids_of(text)[:-1].tobytes()]
        sizes.append(sum(len(piece) + len(ids) for piece, ids in tokenizer.known.items()))
    # what one call learns may come on top
    assert max(sizes) <= (1 << 20) + 2 * sizes[0]


def test_second_pass_lets_go_of_what_the_first_remembered():
    packing._tokenizer(TOKENIZER).encode(["hello world"])
    hold("packing", packing._loaded.clear)
    assert list(packing._cut(16, True)(iter([]))) == [] and not packing._loaded


@pytest.mark.parametrize("window", [16, 4096])
def test_pieces_cover_every_id_once(spark, window):
    docs = documents(spark, odd((7, "hello, world"), (8, "x " * 3000)))
    pieces = packing.pack(docs, TOKENIZER, window=window).collect()
    total = sum(len(ids_of(t)) for _, t in odd((7, "hello, world"), (8, "x " * 3000)))
    places = sorted((p.sequence_id, p.offset, p.length) for p in pieces)
    at = 0
    for sequence, offset, length in places:
        assert sequence * window + offset == at and offset + length <= window
        at += length
    assert at == total
    for p in pieces:
        assert p.ids_crc32 == zlib.crc32(p.ids) and len(p.ids) == 4 * p.length
    by_doc = {}
    for p in sorted(pieces, key=lambda p: p.start):
        by_doc.setdefault((p.doc_id, p.doc_tokens), []).append(p)
    text = dict(t for t in odd((7, "hello, world"), (8, "x " * 3000)))
    for (doc, tokens), own in by_doc.items():
        if doc == 5:
            continue
        assert b"".join(p.ids for p in own) == ids_of(text[doc]).tobytes() and tokens == len(ids_of(text[doc]))
    last = max(p.sequence_id for p in pieces)
    rest = total - last * window
    for p in pieces:
        assert p.sequence_length == (window if p.sequence_id < last else 1 << (rest - 1).bit_length())


def test_sequences_put_the_pieces_together(spark):
    docs = documents(spark, [(i, f"text number {i} " * i) for i in range(30)])
    pieces = packing.pack(docs, TOKENIZER, window=64)
    whole = {r.sequence_id: r for r in packing.sequences(pieces).collect()}
    for row in whole.values():
        assert len(row.ids) == 4 * sum(r.length for r in row.records)
        assert [r.offset for r in row.records] == sorted(r.offset for r in row.records)
    assert sorted(whole) == list(range(len(whole)))


def test_empty_table(spark):
    assert packing.pack(documents(spark, []), TOKENIZER).count() == 0
