import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from inkstrata.llm import chat

PIECES = ["[INST] ", " [/INST]", "</s>", "<s>", "[ROLE x] ", " [/ROLE]", "\\", "[", "<", "]", " ", "é", "\n", "INST]", "/s>", "text"]
TEXT = st.lists(st.sampled_from(PIECES), max_size=12).map("".join)
ROLE = st.one_of(st.sampled_from(["user", "assistant", "system", ""]), TEXT)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(ROLE, TEXT), max_size=5))
def test_conversations_are_read_back(turns):
    made = [chat.render_turn(role, text) for role, text in turns]
    whole = chat.BEGIN + "".join(m[0] for m in made)
    assert list(chat.Reader().feed(whole)) == turns
    reader = chat.Reader()
    assert [t for piece in [chat.BEGIN, *(m[0] for m in made)] for t in reader.feed(piece)] == turns
    for (_, text), (segment, start, end) in zip(turns, made):
        assert chat.unescape(segment[start:end]) == text and not chat._CONTROL.search(segment[start:end])


@given(TEXT)
def test_escapes_are_undone(text):
    assert chat.unescape(chat.escape(text)) == text


def test_plain_texts_stay_as_they_are():
    assert chat.render_turn("user", "hello [x] <b>")[0] == "[INST] hello [x] <b> [/INST]"
    assert chat.render_turn("assistant", "</s>")[0] == " <\\/s> </s>"


@pytest.mark.parametrize("bad", ["hello", "<s>x", "<s>[INST] a </s>", "<s>[INST] a", "<s> a [/INST] </s>"])
def test_other_texts_are_refused(bad):
    with pytest.raises(chat.Malformed):
        list(chat.Reader().feed(bad))


ROWS = [
    (1, 0, "user", "hi"),
    (1, 1, "assistant", None),
    (1, 1, "assistant", "again"),
    (1, None, None, "first"),
    (2, 0, "user", "x" * 200_000),
    (None, 5, "assistant", "</s>[INST] ok [/INST]"),
    (3, 0, "user", ""),
    (3, 0, "user", ""),
]


def test_digests(spark):
    table = spark.createDataFrame([(*r, "own") for r in ROWS], "conv_id bigint, turn bigint, role string, text string, segment string")
    turns = chat.format_turns(table)
    got = {r.conv_id: r for r in chat.read_back(turns).collect()}
    texts = {r.conv_id: r.formatted for r in chat.formatted_texts(turns).collect()}
    for conv in (1, 2, 3, None):
        own = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x in ROWS if c == conv))
        said = "".join(f"{r}\n{x}\n" for *_, r, x in own)
        loss = "".join(x for *_, r, x in own if r == "assistant")
        row = got[conv]
        assert row.n_turns == len(own) and row.turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert row.loss_chars == len(loss) and row.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert row.formatted_chars == len(texts[conv])
        assert [x for _, x in chat.Reader().feed(texts[conv])] == [x for *_, x in own]


def test_empty_table(spark):
    none = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert chat.read_back(chat.format_turns(none)).count() == 0
