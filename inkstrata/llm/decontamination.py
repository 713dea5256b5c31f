"""Benchmark decontamination by Wu-Manber multi-pattern search.

The test strings are the windows of 13 words of the benchmark items. A text is
brought to the same form, words parted by single spaces, and searched with a window
of the length of the shortest string: the block of bytes at its end tells how far it
can be moved without missing a string; where that is nothing, the block selects the
strings that hold it there, and direct comparison confirms them.

The strings are searched in groups of bounded size, so the benchmark may be of any
size; every text is searched whole. With several groups the corpus is written once,
and each pass adds the marks of the texts that it has hit.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkstrata.llm.common import hold, schema_with, slices, texts_of
from inkstrata.session import materialize

WINDOW = 13
BLOCK = 8
# Strings from these lengths on are searched apart from shorter ones.
CLASSES = (6, 12, 24, 48)
# Bytes of test strings that a pass holds in a worker.
GROUP_BYTES = 8 << 20

_FORM = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or c >= 97 and c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: str) -> list[bytes]:
    """Words of ASCII letters and digits and of other characters, A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").translate(_FORM).split()


class WuManber:
    """Search for byte strings of at least ``m`` bytes, ``m`` being the length of the shortest."""

    def __init__(self, strings: list[bytes]):
        self.m = m = min(map(len, strings))
        self.block = block = min(BLOCK, m // 2 + 1)
        self.far = m - block + 1
        self.shift: dict[bytes, int] = {}
        self.bucket: dict[bytes, list[bytes]] = {}
        for string in strings:
            for end in range(block, m + 1):
                part = string[end - block : end]
                self.shift[part] = min(self.shift.get(part, self.far), m - end)
            self.bucket.setdefault(string[m - block : m], []).append(string)

    def find(self, text: bytes) -> Iterator[tuple[int, bytes]]:
        """``(place, string)`` of every occurrence, by place."""
        at, size, block, m, far = self.m, len(text), self.block, self.m, self.far
        shift = self.shift.get
        while at <= size:
            part = text[at - block : at]
            step = shift(part, far)
            if step:
                at += step
                continue
            for string in self.bucket[part]:
                if text.startswith(string, at - m):
                    yield at - m, string
            at += 1


class Searcher:
    """The test strings of one group, with their lengths in words and their items."""

    def __init__(self, rows: list[tuple[bytes, int, str]]):
        self.meaning: dict[bytes, tuple[int, list[str]]] = {}
        for string, width, item in rows:
            self.meaning.setdefault(string, (width, []))[1].append(item)
        classes: dict[int, list[bytes]] = {}
        for string in self.meaning:
            classes.setdefault(sum(len(string) >= c for c in CLASSES), []).append(string)
        self.machines = [WuManber(strings) for strings in classes.values()]

    def mark(self, words: list[bytes], marks: bytearray, items: set[str]) -> None:
        """Set the marks of words inside occurrences, add the items they belong to."""
        text = b" %s " % b" ".join(words)
        for machine in self.machines:
            place, word = 0, 0
            for start, string in machine.find(text):
                word += text.count(b" ", place, start)
                place = start
                width, owners = self.meaning[string]
                marks[word : word + width] = b"\x01" * width
                items.update(owners)


def test_strings(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``string, width, item``: the windows of every item of ``benchmark`` (``item_id, text``).

    An item of fewer words than a window is one string, an item without words none.
    A null ``item_id`` counts as the id of no characters; ids are taken as strings.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for item, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                words = words_of(text)
                width = min(window, len(words))
                if width:
                    rows += [(b" %s " % b" ".join(words[i : i + width]), width, item) for i in range(len(words) - width + 1)]
            columns = list(zip(*rows)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.string())], names=["string", "width", "item"]
            )

    ids = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").cast("string"))
    return ids.mapInArrow(run, "string binary, width int, item string").distinct()


# The searcher of the group at hand, one per Python worker.
_current: list[tuple[str, Searcher]] = []


def _searcher(token: str, rows: Broadcast) -> Searcher:
    if not _current or _current[0][0] != token:
        _current[:] = [(token, Searcher(rows.value))]
    return _current[0][1]


def _search(token: str, rows: Broadcast, text: int, keep: int, hits_only: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The first ``keep`` columns and what is found in column ``text``, of all rows or of those with a hit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("decontamination", _current.clear)
        searcher = _searcher(token, rows)
        for batch in slices(batches):
            counts, hits, owners = [], [], []
            for data in texts_of(batch.column(text)):
                words = words_of(data)
                marks, items = bytearray(len(words)), set()
                searcher.mark(words, marks, items)
                counts.append(len(words))
                hits.append(bytes(marks) if items else None)
                owners.append(sorted(items))
            found = pa.RecordBatch.from_arrays(
                [*batch.columns[:keep], pa.array(counts, pa.int64()), pa.array(hits, pa.binary()), pa.array(owners, pa.list_(pa.string()))],
                names=[*batch.schema.names[:keep], *FOUND],
            )
            yield found.filter(found.column(keep + 1).is_valid()) if hits_only else found

    return run


FOUND = ("_decontam_words", "_decontam_marks", "_decontam_items")
_FOUND_DDL = "_decontam_words bigint, _decontam_marks binary, _decontam_items array<string>"


@F.pandas_udf(T.BinaryType())
def _either(marks: pd.Series) -> pd.Series:
    """Marks of a text from several passes, as one; null where no pass has any."""
    return pd.Series([np.bitwise_or.reduce([np.frombuffer(m, np.uint8) for m in of]).tobytes() if len(of) else None for of in marks], dtype=object)


def _find(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with its columns renamed to ``c0, c1, ...``, and the columns ``FOUND``."""
    spark = docs.sparkSession
    strings = materialize(test_strings(benchmark, window), "test-strings")
    size = strings.agg(F.sum(F.octet_length("string") + F.octet_length("item"))).first()[0] or 0
    groups = max(1, -(-size // GROUP_BYTES))
    # items repeat in part; a group is a share of the strings by hash
    strings = strings.withColumn("_group", F.pmod(F.xxhash64("string", "item"), F.lit(groups)))

    def held(group: int) -> Broadcast:
        rows = strings.where(F.col("_group") == group).select("string", "width", "item")
        return spark.sparkContext.broadcast([(bytes(r[0]), r[1], r[2]) for r in rows.collect()])

    plain = [f"c{i}" for i in range(len(docs.columns))]
    text = docs.columns.index("text")
    docs = docs.toDF(*plain)
    if groups == 1:
        return docs.mapInArrow(_search(uuid.uuid4().hex, held(0), text, len(plain), False), schema_with(docs, plain, _FOUND_DDL))
    numbered = materialize(docs.withColumn("row", F.monotonically_increasing_id()), "numbered")
    passes = []
    for group in range(groups):
        rows = held(group)
        search = _search(uuid.uuid4().hex, rows, 1, 1, group > 0)
        passes.append(materialize(numbered.select("row", plain[text]).mapInArrow(search, f"row bigint, {_FOUND_DDL}"), "searched"))
        rows.unpersist()
    every = passes[0]
    for more in passes[1:]:
        every = every.unionByName(more)
    merged = every.groupBy("row").agg(F.max(FOUND[0]).alias(FOUND[0]), F.collect_list(FOUND[1]).alias("marks"), F.collect_list(FOUND[2]).alias("items"))
    merged = merged.select("row", FOUND[0], _either("marks").alias(FOUND[1]), F.array_sort(F.array_distinct(F.flatten("items"))).alias(FOUND[2]))
    return numbered.join(merged, "row").drop("row")


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with ``_decontam_words``, ``_decontam_marks`` and ``_decontam_items``.

    ``_decontam_marks`` has a byte for each word of the text, 1 inside an occurrence of a test
    string, and is null where there is none; ``_decontam_items`` are the ids, as sorted strings,
    of the items found. A null text has no words. Without items nothing is found. Other columns
    may have any names; one named as a new one is an error.
    """
    clash = sorted(set(map(str.lower, docs.columns)) & set(FOUND))
    if clash:
        raise ValueError(f"the table has columns of the names given here: {', '.join(clash)}")
    return _find(docs, benchmark, window).toDF(*docs.columns, *FOUND)


def _contaminated(hits: str, words: str) -> Column:
    """At least a twentieth of the words is hit."""
    return (F.col(hits) > 0) & (20 * F.col(hits) >= F.col(words))


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` of each document.

    A document is contaminated if at least a twentieth of its words are hit.
    """
    found = find_contamination(docs.select("doc_id", "text"), benchmark)
    return found.select(
        "doc_id",
        F.col("_decontam_words").alias("n_words"),
        _hits("_decontam_marks").alias("n_hit"),
        F.size("_decontam_items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("_decontam_items", ","), 256).alias("items_sha256"),
    ).withColumn("contaminated", _contaminated("n_hit", "n_words"))


def _hits(marks: str) -> Column:
    return F.coalesce(F.octet_length(F.replace(F.col(marks).cast("string"), F.lit("\x00"), F.lit(""))), F.lit(0)).cast("bigint")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with the columns of ``docs``, whatever their names."""
    found = _find(docs, benchmark).withColumn("hit", _hits(FOUND[1]))
    return found.where(~_contaminated("hit", FOUND[0])).drop("hit", *FOUND).toDF(*docs.columns)


def sql(window: int = WINDOW) -> str:
    words = (
        "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
        r" '[0-9a-z\x{80}-\x{10FFFF}]+')"
    )
    return f"""
WITH d AS (SELECT doc_id, {words} AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {words} AS w FROM benchmark),
tests AS (
  SELECT DISTINCT item, k, array_to_string(w[i : i + k - 1], ' ') AS s
  FROM (SELECT item, w, least({window}, len(w)) AS k, unnest(range(1, len(w) - least({window}, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM tests),
places AS (
  SELECT doc_id, k, i, array_to_string(w[i : i + k - 1], ' ') AS s
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, sizes WHERE len(w) >= k)),
hits AS (SELECT doc_id, i, places.k, item FROM places JOIN tests USING (s, k)),
marked AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
owned AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN marked USING (doc_id) LEFT JOIN owned USING (doc_id)"""
