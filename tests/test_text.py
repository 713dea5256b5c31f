import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from inkstrata.functions import text as tx
from inkstrata.operators import cleaning, ingest

# text, with code tags, code bodies, with normalized white space
CASES = [
    ("", "", [], ""),
    (" ", " ", [], ""),
    ("plain", "plain", [], "plain"),
    ("```python\nx = 1\n```", "\n<code>\nx = 1\n</code>\n", ["x = 1"], "```python\nx = 1\n```"),
    ("``````", "\n<code>\n\n</code>\n", [""], "``````"),
    ("```\n\n\n```", "\n<code>\n\n</code>\n", [""], "```\n\n```"),
    (
        "a```js\n\n  let a;\n\n```b```c```",
        "a\n<code>\n  let a;\n</code>\nb\n<code>\nc\n</code>\n",
        ["let a;", "c"],
        "a```js\n\n let a;\n\n```b```c```",
    ),
    ("``` unclosed", "``` unclosed", [], "``` unclosed"),
    ("```py\n``` ```\n```", "\n<code>\n\n</code>\n \n<code>\n\n</code>\n", ["", ""], "```py\n``` ```\n```"),
    ("```a b\nc```", "\n<code>\na b\nc\n</code>\n", ["a b\nc"], "```a b\nc```"),
    ("x\r\ny\rz\r\n\r\n\r\nw", "x\r\ny\rz\r\n\r\n\r\nw", [], "x\n\ny\nz\n\nw"),
    ("a \t b\t\tc\td", "a \t b\t\tc\td", [], "a b c\td"),
    ("\u2003 wide \u3000\x85", "\u2003 wide \u3000\x85", [], "wide"),
    ("\x1c\x1d\x1e\x1fctl\x0b\x0c", "\x1c\x1d\x1e\x1fctl\x0b\x0c", [], "ctl"),
    ("\u200bkept\u200b", "\u200bkept\u200b", [], "\u200bkept\u200b"),
    ("😀```\n😀\n```😀  😀", "😀\n<code>\n😀\n</code>\n😀  😀", ["😀"], "😀```\n😀\n```😀 😀"),
    ("\n\n\n\n", "\n\n\n\n", [], ""),
    ("```\n" + "\n" * 500 + "x", "```\n" + "\n" * 500 + "x", [], "```\n\nx"),
]
TEXTS, TAGGED, BODIES, NORMALIZED = ([case[i] for case in CASES] for i in range(4))
LANGUAGE = set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_+-")


def fenced(text):
    """What lies between fences, found by their places; a language line is not part of it."""
    places, at = [], text.find("```")
    while at >= 0:
        places.append(at)
        at = text.find("```", at + 3)
    bodies = []
    for start, end in zip(places[::2], places[1::2]):
        head, newline, rest = text[start + 3 : end].partition("\n")
        bodies.append(rest if newline and head and set(head) <= LANGUAGE else head + newline + rest)
    return bodies


def column(spark, values, build):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r["o"] for r in rows.select("i", build(F.col("t")).alias("o")).orderBy("i").collect()]


def test_strip_matches_python(spark):
    every = [chr(c) + "x" + chr(c) for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    assert column(spark, every, tx.strip) == [v.strip() for v in every]
    assert column(spark, TEXTS, tx.strip) == [v.strip() for v in TEXTS]


def test_code_blocks_and_whitespace(spark):
    assert column(spark, TEXTS, tx.tag_code_blocks) == TAGGED
    assert column(spark, TEXTS, tx.code_blocks) == BODIES
    assert column(spark, TEXTS, tx.normalize_whitespace) == NORMALIZED


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="`\n\r\t ab1+é😀 ", max_size=60), min_size=1, max_size=40))
def test_cleaning_of_any_text(spark, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    once = cleaning.process_examples(rows, keep=["i"])
    got = once.orderBy("i").collect()
    again = [r["text"] for r in cleaning.process_examples(once.select("i", "text"), keep=["i"]).orderBy("i").collect()]
    assert again == [r["text"] for r in got]
    for row, text in zip(got, texts):
        clean, bodies = row["text"], fenced(text)
        assert clean == clean.strip() and row["num_chars"] == len(clean)
        assert not any(run in clean for run in ("\r", "\n\n\n", "  ", "\t\t", " \t", "\t "))
        assert clean.count("<code>") == clean.count("</code>") == row["num_code_blocks"] == len(bodies)
        assert row["code_blocks"] == ("\n\n".join(body.strip() for body in bodies) if bodies else None)
        # nothing but fences, language lines and white space goes
        kept = "".join(clean.replace("<code>", "").replace("</code>", "").split())
        outside = text
        for body in bodies:
            start = outside.index("```")
            end = outside.index("```", start + 3)
            outside = outside[:start] + body.replace("`", "\0") + outside[end + 3 :]
        assert kept == "".join(outside.replace("\0", "`").split())


def test_records_keep_license_and_drop_missing_text(spark):
    rows = spark.createDataFrame([("a", "mit"), (None, "mit"), ("b", None)], "body string, license string")
    got = cleaning.process_examples(rows, "body").collect()
    assert [(r["text"], r["license"]) for r in got] == [("a", "mit"), ("b", None)]
    with pytest.raises(KeyError, match="body, license"):
        cleaning.process_examples(rows, "text")


def test_words(spark):
    texts = ["", " ", " a  12b c3\n4 ", "x", "7", "\x0bq\x1cr é1"]
    expected = [re.findall("[0-9]|[^0-9\t-\r ]+", t) for t in texts]
    assert column(spark, texts, tx.words) == expected


def test_prompts(spark):
    row = spark.range(1).select(
        tx.retrieval_prompt(F.lit("why?"), F.array().cast("array<string>")).alias("empty"),
        tx.citation_line(F.lit(2), F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit(0.12345)).alias("line"),
        tx.text_after_marker(F.lit("a Assistant: b Assistant: c ")).alias("after"),
        tx.shard_dir_name(F.lit("a/b"), F.lit("c")).alias("dir"),
        tx.shard_dir_name(F.lit("a/b"), F.lit("")).alias("bare"),
        tx.file_suffix(F.lit("/x.y/.hidden")).alias("hidden"),
        tx.file_suffix(F.lit("/x.y/a.tar.MD")).alias("suffix"),
    ).first()
    assert row["empty"].endswith("Context:\nNo context available.\n\nUser question: why?\nAssistant:")
    assert row["line"] == "[2] unknown@HEAD (score=0.123)"
    assert (row["after"], row["dir"], row["bare"]) == ("c", "a_b__c", "a_b")
    assert (row["hidden"], row["suffix"]) == ("", ".MD")


def test_test_lists(spark):
    given_, want = ['["a", "b"]', "not json", None, "[]"], [["a", "b"], ["not json"], [], []]
    assert column(spark, given_, tx.test_list) == want


def test_html_text():
    assert ingest.html_text("<p>a<b>b</b></p><!-- no --><script>x<y</script>&amp;&copy;") == "abx<y&©"
    assert ingest.html_text("<p>a<script>never closed") == "a"
