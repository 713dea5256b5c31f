"""Bigram counts and losses over numbered words.

The frequent words of a corpus, a bounded number, are numbered and broadcast; a pair of them
is one integer. Other pairs are strings ``w1 w2`` (words hold no blanks), and what a word that
is not numbered begins is counted under the word alone. Some megabytes of texts at a time are
taken apart and counted in Arrow batches, and dealt out to buckets by pair as sorted arrays.
Spark groups the buckets; a bucket has about as many pairs however large the corpus is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkstrata.operators.vocabulary import bounded_parts
from inkstrata.session import materialize

# Numbered words, their bytes in all, and the longest of them.
FREQUENT_WORDS, FREQUENT_BYTES, WORD_BYTES = 1 << 19, 32 << 20, 1 << 10
# Pairs of numbered words whose counts every task may hold.
FREQUENT_PAIRS = 1 << 20
# Bytes of texts that are taken apart at once, and occurrences a bucket stands for.
PART_BYTES, BUCKET_WORDS = 16 << 20, 1 << 20

_COUNTS = "bucket int, pairs array<bigint>, n array<bigint>, others array<string>, other_n array<bigint>"


@dataclass(frozen=True)
class BigramModel:
    """Add-one smoothed bigrams: a pair has probability ``(n + 1) / (h + vocabulary)``.

    ``history`` has ``w1, h``, the pairs that ``w1`` begins. ``n`` is 0 for an unseen
    pair, ``h`` for an unseen word. ``counts`` has the pair counts by bucket, in arrays;
    ``words`` the numbered words and their ``h``.
    """

    counts: DataFrame
    history: DataFrame
    vocabulary: int
    words: Broadcast
    buckets: int

    def log_prob(self, n: Column, h: Column) -> Column:
        return F.log((F.coalesce(n, F.lit(0)) + 1) / (F.coalesce(h, F.lit(0)) + max(1, self.vocabulary)))

    @property
    def pairs(self) -> DataFrame:
        """``w1, w2, n``, row by row."""
        words = self.words

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = words.value[0]
            for batch in batches:
                keys, n, others, other_n = _flat(batch)
                names = known.take(pa.array(keys >> 32)), known.take(pa.array(keys & 0xFFFFFFFF))
                yield pa.RecordBatch.from_arrays([*names, pa.array(n)], names=["w1", "w2", "n"])
                both = np.char.find(others.astype(str), " ") > 0 if len(others) else np.zeros(0, bool)
                first, second = [[x.split(" ")[i] for x in others[both]] for i in (0, 1)]
                columns = [pa.array(first, pa.string()), pa.array(second, pa.string()), pa.array(other_n[both])]
                yield pa.RecordBatch.from_arrays(columns, names=["w1", "w2", "n"])

        return self.counts.mapInArrow(run, "w1 string, w2 string, n bigint")


def _flat(table: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The arrays of all rows one after the other: pairs, their counts, other strings, their counts."""
    return tuple(_flatten(table.column(name)).to_numpy(zero_copy_only=False) for name in ("pairs", "n", "others", "other_n"))


def _flatten(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    return column.flatten()


class Tokens:
    """The words of a batch of texts as ``functions.text.words`` cuts them: ``codes`` into ``words``, text by text.

    ``text`` is the text of each word; ``sizes`` the words of each text, at most ``most``.
    """

    def __init__(self, texts: pa.Array, most: int | None = None):
        texts = texts.cast(pa.large_binary()) if len(texts) else pa.array([], pa.large_binary())
        # null texts may stand for any bytes
        texts = pc.fill_null(texts, b"")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        data = np.frombuffer(data if data is not None else b"", np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        blank = (data == 32) | (data - np.uint8(9) < 5)
        digit = data - np.uint8(48) < 10
        # a word begins behind a blank, at and behind a digit, and with a text
        start = digit.copy()
        start[1:] |= blank[:-1] | digit[:-1]
        start[offsets[:-1][offsets[:-1] < len(data)]] = True
        solid = ~blank
        start &= solid
        at = np.flatnonzero(start)
        letters = data[solid]
        ends = np.r_[np.flatnonzero(start[solid]), len(letters)].astype(np.int64)
        words = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(ends), pa.py_buffer(letters)])
        first = np.searchsorted(at, offsets)
        self.sizes = np.diff(first)
        encoded = words.dictionary_encode()
        self.words = encoded.dictionary.cast(pa.binary())
        self.codes = encoded.indices.to_numpy(zero_copy_only=False)
        self.text = np.repeat(np.arange(len(texts)), self.sizes)
        if most is not None:
            keep = np.arange(len(at)) - np.repeat(first[:-1], self.sizes) < most
            self.codes, self.text, self.sizes = self.codes[keep], self.text[keep], np.minimum(self.sizes, most)
        # places that another word of the same text follows
        self.begins = np.flatnonzero(self.text[1:] == self.text[:-1])


class Pairs:
    """The pairs of a batch of texts: integers where both words are numbered, else strings.

    Places of integers are ``at``, those of others ``rest``; ``lone`` are the places whose
    first word is not numbered.
    """

    def __init__(self, tokens: Tokens, known: pa.Array):
        number = pc.fill_null(pc.index_in(tokens.words, value_set=known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        self.tokens = tokens
        self.first, second = number[tokens.codes[tokens.begins]], number[tokens.codes[tokens.begins + 1]]
        plain = (self.first >= 0) & (second >= 0)
        self.at, self.rest = tokens.begins[plain], tokens.begins[~plain]
        self.keys = self.first[plain] << 32 | second[plain]
        self.lone = tokens.begins[self.first < 0]

    def others(self) -> tuple[pa.Array, np.ndarray]:
        """Strings of pairs that are not all numbers, then of first words without one; their places."""
        words, codes = self.tokens.words, self.tokens.codes
        joined = pc.binary_join_element_wise(words.take(pa.array(codes[self.rest])), words.take(pa.array(codes[self.rest + 1])), b" ")
        alone = words.take(pa.array(codes[self.lone]))
        return pa.concat_arrays([joined, alone.cast(joined.type)]), np.r_[self.rest, self.lone]


def _buckets(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % buckets


def _string_buckets(strings: pa.Array, buckets: int) -> np.ndarray:
    """Buckets by a sum over the bytes, each times a power of its place."""
    strings = strings.cast(pa.large_binary())
    offsets = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset : strings.offset + len(strings) + 1]
    data = strings.buffers()[2]
    data = np.frombuffer(data if data is not None else b"", np.uint8)[offsets[0] : offsets[-1]].astype(np.uint64)
    sizes = np.diff(offsets)
    place = np.arange(len(data)) - np.repeat(offsets[:-1] - offsets[0], sizes)
    mixed = (data + np.uint64(1)) * ((place.astype(np.uint64) * np.uint64(2) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0x9E3779B97F4A7C15)
    sums = np.zeros(len(strings), np.uint64)
    full = np.flatnonzero(sizes)
    if len(full):
        sums[full] = np.add.reduceat(mixed, (offsets[:-1] - offsets[0])[full])
    return _buckets(sums, buckets)


def _lists(buckets: np.ndarray, count: int, *columns: np.ndarray | pa.Array) -> list[pa.Array]:
    """``columns`` as one list per bucket; rows of a bucket keep their order."""
    small = buckets.astype(np.uint16) if count <= 1 << 16 else buckets
    order = np.argsort(small, kind="stable")
    offsets = pa.array(np.searchsorted(buckets[order], np.arange(count + 1)).astype(np.int32))
    taken = (c.take(pa.array(order)) if isinstance(c, pa.Array) else pa.array(c[order]) for c in columns)
    return [pa.ListArray.from_arrays(offsets, c) for c in taken]


def _full(batch: pa.RecordBatch, *lists: str) -> pa.RecordBatch:
    """The rows in which one of the lists has something."""
    sizes = sum(pc.list_value_length(batch.column(name)).to_numpy(zero_copy_only=False) for name in lists)
    return batch.filter(pa.array(sizes > 0))


def _strings(column: pa.Array) -> pa.Array:
    return column.cast(pa.binary()).cast(pa.string())


def _summed(strings: pa.Array, n: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    encoded = strings.dictionary_encode()
    codes = encoded.indices.to_numpy(zero_copy_only=False)
    sums = np.bincount(codes, weights=n, minlength=len(encoded.dictionary)).astype(np.int64)
    return encoded.dictionary, sums


def count_words(texts: DataFrame, text: str = "text") -> DataFrame:
    """``w1, n, h``: every word of the corpus, its occurrences, and the pairs that it begins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in batches for p in bounded_parts(batch, PART_BYTES)):
            tokens = Tokens(part.column(0))
            n = np.bincount(tokens.codes, minlength=len(tokens.words))
            h = np.bincount(tokens.codes[tokens.begins], minlength=len(tokens.words))
            yield pa.RecordBatch.from_arrays([_strings(tokens.words), pa.array(n), pa.array(h)], names=["w1", "n", "h"])

    counted = texts.select(text).mapInArrow(run, "w1 string, n bigint, h bigint")
    return counted.groupBy("w1").agg(F.sum("n").alias("n"), F.sum("h").alias("h"))


def _frequent_words(history: DataFrame) -> pa.Table:
    """``w1, h`` of the most frequent words, bounded in number and bytes, by a coarse histogram."""
    step, short = F.floor(4 * F.log2("n")), F.octet_length("w1") <= WORD_BYTES
    steps = history.where(short).groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words"), F.sum(F.octet_length("w1")).alias("bytes")).collect()
    words, size, least = FREQUENT_WORDS, FREQUENT_BYTES, None
    for row in sorted(steps, key=lambda r: -r["step"]):
        words, size = words - row["words"], size - row["bytes"]
        if words < 0 or size < 0:
            break
        least = row["step"]
    chosen = history.where(short & (step >= least)) if least is not None else history.limit(0)
    return chosen.select("w1", "h").toArrow()


def learn_bigrams(texts: DataFrame, text: str = "text") -> BigramModel:
    """Bigrams of the whole corpus.

    The corpus is read twice, for the words and for the pairs of numbered words; both
    counts are written to the shared folder.
    """
    spark = texts.sparkSession
    history = materialize(count_words(texts, text), "bigram-words")
    vocabulary, total = history.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    buckets = max(1, -(-total // BUCKET_WORDS))
    top = _frequent_words(history).combine_chunks()
    known = top.column("w1").combine_chunks() if top.num_rows else pa.array([], pa.string())
    known = known.chunk(0) if isinstance(known, pa.ChunkedArray) else known
    words = spark.sparkContext.broadcast((known.cast(pa.string()), top.column("h").to_numpy()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = words.value[0].cast(pa.binary())
        for part in (p for batch in batches for p in bounded_parts(batch, PART_BYTES)):
            pairs = Pairs(Tokens(part.column(0)), known)
            keys, n = np.unique(pairs.keys, return_counts=True)
            others, places = pairs.others()
            others, other_n = _summed(others, np.ones(len(places)))
            lists = [
                *_lists(_buckets(keys, buckets), buckets, keys, n.astype(np.int64)),
                *_lists(_string_buckets(others, buckets), buckets, _strings(others), other_n),
            ]
            names = ["bucket", "pairs", "n", "others", "other_n"]
            yield _full(pa.RecordBatch.from_arrays([pa.array(np.arange(buckets, dtype=np.int32)), *lists], names=names), "pairs", "others")

    def add(bucket: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        keys, n, _, other_n = _flat(rows)
        order = np.argsort(keys, kind="stable")
        keys, n = keys[order], n[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])
        sums = np.add.reduceat(n, first) if len(first) else n
        others, other_n = _summed(_flatten(rows.column("others")), other_n)
        columns = pa.array(keys[first]), pa.array(sums), others, pa.array(other_n)
        lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in columns]
        return pa.table([pa.array([bucket[0].as_py()], pa.int32()), *lists], names=["bucket", "pairs", "n", "others", "other_n"])

    counted = texts.select(text).mapInArrow(count, _COUNTS).groupBy("bucket").applyInArrow(add, _COUNTS)
    return BigramModel(materialize(counted, "bigrams"), history.select("w1", "h"), vocabulary, words, buckets)


def _frequent_pairs(model: BigramModel, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent pairs of numbered words, at most ``limit``, in order, and their counts."""

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, pairs = np.unique(np.floor(4 * np.log2(_flat(batch)[1])).astype(np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(pairs)], names=["step", "pairs"])

    rows = model.counts.mapInArrow(steps, "step bigint, pairs bigint").groupBy("step").agg(F.sum("pairs").alias("pairs")).collect()
    room, least = limit, None
    for row in sorted(rows, key=lambda r: -r["step"]):
        room -= row["pairs"]
        if room < 0:
            break
        least = row["step"]
    if least is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, n, _, _ = _flat(batch)
            often = np.floor(4 * np.log2(n)).astype(np.int64) >= least
            yield pa.RecordBatch.from_arrays([pa.array(keys[often]), pa.array(n[often])], names=["pair", "n"])

    table = model.counts.mapInArrow(chosen, "pair bigint, n bigint").toArrow()
    keys, n = table.column("pair").to_numpy(), table.column("n").to_numpy()
    order = np.argsort(keys)
    return keys[order], n[order]


def _places(keys: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where ``keys`` stand in sorted ``among``, and whether they do."""
    if not len(among):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(among, keys), len(among) - 1)
    return at, among[at] == keys


def _only(model: BigramModel, asked: DataFrame) -> DataFrame:
    """The counts of the few pairs that ``asked`` names; the model is read in place."""
    table = asked.select("pairs", "others").toArrow()
    wanted = np.unique(_flatten(table.column("pairs")).to_numpy(zero_copy_only=False).astype(np.int64))
    shared = model.counts.sparkSession.sparkContext.broadcast((wanted, _flatten(table.column("others")).unique().cast(pa.string())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, strings = shared.value
        for batch in batches:
            for row in (batch.slice(i, 1) for i in range(batch.num_rows)):
                keys, n, _, other_n = _flat(row)
                others = _flatten(row.column("others"))
                here, there = _places(keys, pairs)[1], pc.is_in(others, value_set=strings.cast(others.type))
                kept = pa.array(keys[here]), pa.array(n[here]), others.filter(there), pa.array(other_n).filter(there)
                lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in kept]
                yield _full(pa.RecordBatch.from_arrays([row.column("bucket"), *lists], names=row.schema.names), "pairs", "others")

    return model.counts.mapInArrow(run, _COUNTS)


def bigram_loss(
    texts: DataFrame,
    model: BigramModel,
    key: str,
    text: str = "text",
    max_length: int | None = None,
    small: bool = False,
    frequent: int = FREQUENT_PAIRS,
) -> DataFrame:
    """``key, loss, n``: mean negative log-probability and number of words per text.

    Pairs and words that the model has not seen count with their smoothed
    probabilities. Texts of fewer than two words have no loss. The ``frequent`` most
    frequent pairs of the model are looked up in place, and so are all numbered words;
    the other pairs meet their counts by bucket. ``small`` says that the texts have few
    enough pairs to broadcast (a bounded number of texts of bounded length): only their
    pairs leave the model.
    """
    spark = texts.sparkSession
    rows = texts.select(F.col(key), F.col(text).alias("_text"))
    if small:
        rows = materialize(rows, "sample-texts")
    held = (np.zeros(0, np.int64),) * 2 if small else _frequent_pairs(model, frequent)
    held, words, buckets, smooth = spark.sparkContext.broadcast(held), model.words, model.buckets, max(1, model.vocabulary)
    kind = rows.schema[0].dataType

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Pairs, np.ndarray, np.ndarray]]:
        known = words.value[0].cast(pa.binary())
        for part in (p for batch in batches for p in bounded_parts(batch, PART_BYTES)):
            pairs = Pairs(Tokens(part.column(1), max_length), known)
            yield part, pairs, *_places(pairs.keys, held.value[0])

    def in_place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, pairs, place, found in parts(batches):
            text, count = pairs.tokens.text, part.num_rows
            numbered = pairs.first >= 0
            h = words.value[1][pairs.first[numbered]]
            # sums over no rows at all are integers
            lp = -np.bincount(text[pairs.tokens.begins[numbered]], np.log(h + smooth), count).astype(float)
            lp += np.bincount(text[pairs.at[found]], np.log(held.value[1][place[found]] + 1), count)
            n = pa.array(pairs.tokens.sizes.astype(np.int32), mask=part.column(1).is_null().to_numpy(zero_copy_only=False))
            pairs_n = np.bincount(text[pairs.tokens.begins], minlength=count)
            yield pa.RecordBatch.from_arrays([part.column(0), n, pa.array(lp), pa.array(pairs_n)], names=[key, "n", "lp", "pairs"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, pairs, _, found in parts(batches):
            text = pairs.tokens.text
            keys, owner = pairs.keys[~found], text[pairs.at[~found]]
            others, places = pairs.others()
            other_owner = text[places]
            lists = [
                *_lists(_buckets(keys, buckets), buckets, keys, part.column(0).take(pa.array(owner))),
                *_lists(_string_buckets(others, buckets), buckets, _strings(others), part.column(0).take(pa.array(other_owner))),
            ]
            names = ["bucket", "pairs", "owners", "others", "other_owners"]
            yield _full(pa.RecordBatch.from_arrays([pa.array(np.arange(buckets, dtype=np.int32)), *lists], names=names), "pairs", "others")

    def answer(counted: pa.Table, asked: pa.Table) -> pa.Table:
        keys, n, _, other_n = _flat(counted)
        order = np.argsort(keys, kind="stable")
        keys, n = keys[order], n[order]
        place, seen = _places(_flatten(asked.column("pairs")).to_numpy(zero_copy_only=False), keys)
        lp = np.zeros(len(place))
        lp[seen] = np.log(n[place[seen]] + 1)
        strings, names = _flatten(asked.column("others")), _flatten(counted.column("others"))
        at = pc.index_in(strings, value_set=names.cast(strings.type)).fill_null(-1).to_numpy(zero_copy_only=False)
        times = np.where(at >= 0, other_n[np.maximum(at, 0)], 0) if len(other_n) else np.zeros(len(at))
        pair = pc.match_substring(strings, " ").to_numpy(zero_copy_only=False).astype(bool)
        other = np.where(pair, np.log(times + 1), -np.log(times + smooth))
        owners = pa.concat_arrays([_flatten(asked.column("owners")), _flatten(asked.column("other_owners"))]).dictionary_encode(null_encoding="encode")
        sums = np.bincount(owners.indices.to_numpy(zero_copy_only=False), np.r_[lp, other], len(owners.dictionary)).astype(float)
        return pa.table([owners.dictionary, pa.array(sums)], names=[key, "lp"])

    own = T.StructField(key, kind)
    in_texts = T.StructType([own, *T.StructType.fromDDL("n int, lp double, pairs bigint").fields])
    lists = [T.StructField("pairs", T.ArrayType(T.LongType())), T.StructField("owners", T.ArrayType(kind))]
    lists += [T.StructField("others", T.ArrayType(T.StringType())), T.StructField("other_owners", T.ArrayType(kind))]
    scored = materialize(rows.mapInArrow(in_place, in_texts), "bigram-texts")
    asked = rows.mapInArrow(ask, T.StructType([T.StructField("bucket", T.IntegerType()), *lists]))
    if small:
        asked = materialize(asked, "asked-pairs")
    counts = _only(model, asked) if small else model.counts
    answered = counts.groupBy("bucket").cogroup(asked.groupBy("bucket")).applyInArrow(answer, T.StructType([own, T.StructField("lp", T.DoubleType())]))
    sums = scored.select(key, "lp", "pairs").unionByName(answered.withColumn("pairs", F.lit(0).cast("bigint")))
    losses = sums.groupBy(key).agg((-F.sum("lp")).alias("lp"), F.sum("pairs").alias("pairs"))
    losses = losses.where(F.col("pairs") > 0).select(key, (F.col("lp") / F.col("pairs")).alias("loss"))
    return scored.select(key, "n").join(losses, key, "left").select(key, "loss", "n")
