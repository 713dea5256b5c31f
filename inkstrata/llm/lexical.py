"""Ranked lexical search of documents for a table of items, by Aho-Corasick scan.

There is no document index. The terms of all items, each between two blanks, make
one automaton; a text, with every run of other characters as blanks, runs through it
whole, and what the automaton puts out is the term's number, by which the items of
the term and its repeats in them are found. One scan counts the corpus (documents,
terms, documents of each item term), a second one scores every document for every
item it shares a term with and keeps the best of each item in the task.

Items are searched in groups of bounded size, two scans for each group, so the table
of items may be of any size.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkstrata.llm.common import hold, slices, texts_of
from inkstrata.session import materialize

TOP = 10
# Bytes of item terms, repeats included, that one automaton stands for.
GROUP_BYTES = 2 << 20
# Scores (documents by items) and shares of scores held at once.
BLOCK_SCORES = 2 << 20
BLOCK_SHARES = 4 << 20
# Hits of one task that wait for being cut down to the best of each item.
WAITING = 200_000
# Sub-keys of an item in the first of the two steps that merge the tasks' best.
MERGE_KEYS = 32

_FORM = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or c >= 97 and c <= 122 or c >= 128 else 32 for c in range(256))
# Rows of the counting scan that hold the corpus's documents and terms.
_DOCUMENTS, _TERMS = -1, -2


def form(text: str) -> bytes:
    """UTF-8 of ``text``, A-Z in lower case, a blank for every other ASCII character that is no digit."""
    return text.encode("utf-8", "surrogatepass").translate(_FORM)


class Matcher:
    """Automaton of the terms of a group of items, and the items of each term.

    ``rows`` are ``(item number, term, repeats)``.
    """

    def __init__(self, rows: list[tuple[int, bytes, int]]):
        self.terms = sorted({term for _, term, _ in rows})
        self.items = 1 + max((item for item, _, _ in rows), default=-1)
        number = {term: i for i, term in enumerate(self.terms)}
        ordered = sorted((number[term], item, repeats) for item, term, repeats in rows)
        columns = np.array(ordered, dtype=np.int64).reshape(-1, 3)
        self.first = np.searchsorted(columns[:, 0], np.arange(len(self.terms) + 1))
        self.item, self.repeats = columns[:, 1].copy(), columns[:, 2].copy()
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for term, i in number.items():
            self.automaton.add_word(f" {term.decode('utf-8', 'surrogatepass')} ", i)
        self.automaton.make_automaton()

    def counts(self, text: str) -> tuple[int, dict[int, int]]:
        """Number of all terms of ``text``, and the occurrences of each item term in it."""
        data = form(text)
        length = len(data.split())
        if not length or not self.terms:
            return length, {}
        # matches share the blank between them
        found = self.automaton.iter(f" {data.decode('utf-8', 'surrogatepass')} ")
        return length, Counter(map(itemgetter(1), found))

    def scores(self, documents: int, of: np.ndarray, term: np.ndarray, share: np.ndarray) -> np.ndarray:
        """Documents by items: the sum of ``share`` (of document ``of``, for ``term``) over the item's terms."""
        out = np.zeros(documents * self.items, dtype=np.int64)
        width = self.first[term + 1] - self.first[term]
        ends = np.cumsum(width)
        at = 0
        while at < len(term):
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + BLOCK_SHARES, "right")))
            own = width[at:to]
            place = np.arange(own.sum()) + np.repeat(self.first[term[at:to]] - (np.cumsum(own) - own), own)
            cell = np.repeat(of[at:to] * self.items, own) + self.item[place]
            np.add.at(out, cell, np.repeat(share[at:to], own) * self.repeats[place])
            at = to
        return out.reshape(documents, self.items)


def _count(matcher: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("lexical")
        machine = matcher.value
        documents = terms = 0
        holding = np.zeros(len(machine.terms), dtype=np.int64)
        for batch in slices(batches):
            for text in texts_of(batch.column(1)):
                length, found = machine.counts(text)
                documents += length > 0
                terms += length
                holding[np.fromiter(found, dtype=np.int64, count=len(found))] += 1
        seen = np.flatnonzero(holding)
        yield pa.RecordBatch.from_arrays(
            [pa.array([_DOCUMENTS, _TERMS, *seen.tolist()], pa.int64()), pa.array([documents, terms, *holding[seen].tolist()], pa.int64())],
            names=["term", "n"],
        )

    return run


class _Best:
    """The best hits of each item among the documents of a task."""

    def __init__(self, items: int, top: int, ids: pa.DataType):
        self.top, self.waiting = top, 0
        self.least = np.ones(items, dtype=np.int64)
        self.schema = pa.schema([("item", pa.int64()), ("doc_id", ids), ("score", pa.int64())])
        self.held: list[pa.Table] = []

    def add(self, doc_ids: pa.Array, scores: np.ndarray) -> None:
        # equal scores may still go before, by their ids
        row, item = np.nonzero(scores >= self.least)
        if not len(row):
            return
        columns = [pa.array(item), doc_ids.take(pa.array(row)), pa.array(scores[row, item])]
        self.held.append(pa.Table.from_arrays(columns, schema=self.schema))
        self.waiting += len(row)
        if self.waiting > max(WAITING, 2 * self.top * len(self.least)):
            self.cut()

    def cut(self) -> pa.Table:
        table = pa.concat_tables([self.schema.empty_table(), *self.held])
        order = pc.sort_indices(table, sort_keys=[("item", "ascending"), ("score", "descending"), ("doc_id", "ascending")], null_placement="at_end")
        table = table.take(order)
        item = table.column("item").to_numpy()
        place = np.arange(len(item)) - np.searchsorted(item, item, "left")
        table = table.filter(pa.array(place < self.top))
        item, score = item[place < self.top], table.column("score").to_numpy()
        full = place[place < self.top] == self.top - 1
        self.least[item[full]] = score[full]
        self.held, self.waiting = [table], 0
        return table


def _score(matcher: Broadcast, weights: np.ndarray, documents: int, terms: int, top: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("lexical")
        machine, best = matcher.value, None
        rows = max(1, BLOCK_SCORES // max(1, machine.items))
        for batch in slices(batches):
            best = best or _Best(machine.items, top, batch.column(0).type)
            for at in range(0, batch.num_rows, rows):
                block = batch.slice(at, rows)
                of, term, often, damp = [], [], [], []
                for i, text in enumerate(texts_of(block.column(1))):
                    length, found = machine.counts(text)
                    if found:
                        of += [i] * len(found)
                        term += found.keys()
                        often += found.values()
                        damp += [25 + 75 * length * documents // terms] * len(found)
                tf = np.array(often, dtype=np.int64)
                number = np.array(term, dtype=np.int64)
                share = weights[number] * ((1_000_000_000 * tf) // (1000 * tf + 8 * np.array(damp, dtype=np.int64)))
                best.add(block.column(0), machine.scores(block.num_rows, np.array(of, dtype=np.int64), number, share))
        if best is not None:
            part = TaskContext.get().partitionId() % MERGE_KEYS
            for made in best.cut().combine_chunks().to_batches():
                yield pa.RecordBatch.from_arrays([*made.columns, pa.array([part] * made.num_rows, pa.int32())], names=["item", "doc_id", "score", "part"])

    return run


def item_terms(items: DataFrame) -> DataFrame:
    """``item_id, term, repeats`` of ``items`` (``item_id, text``); rows of one id, null too, are one item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = [form(text).split() for text in texts_of(batch.column(1))]
            rows = pa.array([i for i, own in enumerate(words) for _ in own], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), pa.array([w for own in words for w in own], pa.binary())], names=["item_id", "term"])

    schema = T.StructType([items.schema["item_id"], T.StructField("term", T.BinaryType())])
    made = items.select("item_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)
    return made.groupBy("item_id", "term").agg(F.count(F.lit(1)).alias("repeats"))


def _ranked(hits: DataFrame, keys: list[str], top: int) -> Column:
    return F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))


def rank_documents(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` documents of each item with a score above 0.

    Every row of ``docs`` (``doc_id, text``) is a document, repeated ones too; a null text
    has no terms, a null ``doc_id`` comes after all others of its score. Items without
    terms, and items that no document shares a term with, have no rows; rows of equal
    ``item_id`` are one item. Other columns are not read. No documents give no rows.

    An automaton stands for at most ``GROUP_BYTES`` of item terms, or for a single item.
    A task holds ``top`` hits of each of these items and hands on no more.
    """
    spark = docs.sparkSession
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    terms = materialize(item_terms(items), "item-terms")
    size = terms.agg(F.sum(F.octet_length("term") * F.col("repeats"))).first()[0] or 0
    groups = max(1, -(-size // GROUP_BYTES))
    terms = terms.withColumn("group", F.pmod(F.xxhash64("item_id"), F.lit(groups)))
    ids, of_id, of_doc = items.schema["item_id"].dataType, T.StructField("item_id", items.schema["item_id"].dataType), docs.schema["doc_id"]
    hit = T.StructType([T.StructField("item", T.LongType()), of_doc, T.StructField("score", T.LongType()), T.StructField("part", T.IntegerType())])
    out = spark.createDataFrame([], T.StructType([of_id, T.StructField("rank", T.IntegerType()), of_doc, T.StructField("score", T.LongType())]))
    for group in range(groups):
        rows = terms.where(F.col("group") == group).select("item_id", "term", "repeats").collect()
        if not rows:
            continue
        names = sorted({r["item_id"] for r in rows}, key=lambda x: (x is not None, x))
        number = {name: i for i, name in enumerate(names)}
        made = Matcher([(number[r["item_id"]], bytes(r["term"]), r["repeats"]) for r in rows])
        matcher = spark.sparkContext.broadcast(made)
        counted = texts.mapInArrow(_count(matcher), "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
        counts = {r["term"]: r["n"] for r in counted.collect()}
        documents, total = counts.get(_DOCUMENTS, 0), counts.get(_TERMS, 0)
        if not documents:
            break
        weights = np.array(
            [math.floor(1000 * math.log((2 * documents + 2) / (2 * counts[i] + 1))) if i in counts else 0 for i in range(len(made.terms))], dtype=np.int64
        )
        hits = texts.mapInArrow(_score(matcher, weights, documents, total, top), hit)
        # two steps, so that no task gets the best of all tasks for an item at once
        some = hits.withColumn("rank", _ranked(hits, ["item", "part"], top)).where(F.col("rank") <= top)
        best = some.withColumn("rank", _ranked(some, ["item"], top)).where(F.col("rank") <= top)
        named = spark.createDataFrame(list(enumerate(names)), T.StructType([T.StructField("item", T.LongType()), T.StructField("item_id", ids)]))
        # no more items than an automaton stands for
        out = out.unionByName(best.join(F.broadcast(named), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
    return out


def sql(top: int = TOP) -> str:
    words = (
        "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
        r" '[0-9a-z\x{80}-\x{10FFFF}]+')"
    )
    return f"""
WITH t AS (SELECT doc_id, {words} AS words FROM documents),
d AS (SELECT doc_id, len(words) AS own FROM t WHERE len(words) > 0),
s AS (SELECT count(*) AS docs, CAST(sum(own) AS BIGINT) AS total FROM d),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(words) AS term FROM t) GROUP BY ALL),
q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({words}) AS term FROM benchmark) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf WHERE term IN (SELECT term FROM q) GROUP BY term),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w FROM df, s),
scored AS (
  SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * own * docs) // total)))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN w USING (term) JOIN d USING (doc_id), s GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= {top}"""
