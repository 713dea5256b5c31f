"""Unigram piece vocabularies: expectation maximisation over a word-count table."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkstrata.operators import bpe, codec
from inkstrata.operators import vocabulary as vb
from inkstrata.operators.lattice import MAX_PIECE, Lattice, Trie, best_split, expected_pieces  # noqa: F401
from inkstrata.session import cut_lineage, materialize, spread

# Seeds per vocabulary entry, share kept per pruning.
SEED_FACTOR = 4
KEEP_SHARE = 0.75
# Characters of the substrings that are counted first.
BEGINNING = 6
# Count of a piece that the best splits never need.
FLOOR = 1e-6


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of some batches at a time, so that many words stand side by side."""
    held: list[pa.RecordBatch] = []
    size = 0
    for part in (p for batch in batches for p in vb.bounded_parts(batch)):
        held.append(part)
        size += part.nbytes
        if size >= vb.LOOKUP_BYTES:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _substrings(words: DataFrame, first: int, last: int, begins: Broadcast | None = None) -> DataFrame:
    """``piece, n`` of the substrings of ``first`` to ``last`` characters.

    Some hundred thousand words are counted at a time, all places side by side. ``begins``
    are the only strings of ``first - 1`` characters that a substring may begin with.
    """

    def count(words: list[str], n: np.ndarray) -> Iterator[pa.RecordBatch]:
        text = "".join(words)
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        left, weight = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(codes)), np.repeat(n.astype(float), sizes)
        at, names = np.arange(len(codes)), np.zeros(len(codes), np.int64)
        for size in range(1, last + 1):
            inside = left[at] >= size
            at, names = at[inside], names[inside]
            if not len(at):
                return
            _, where, names = np.unique(names << 21 | codes[at + size - 1], return_index=True, return_inverse=True)
            if size < first and not (begins is not None and size == first - 1):
                continue
            pieces = pa.array([text[i : i + size] for i in at[where].tolist()], pa.string())
            if size >= first:
                sums = np.bincount(names, weight[at]).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pieces, pa.array(sums)], names=["piece", "n"])
            else:
                kept = pc.is_in(pieces, value_set=begins.value).to_numpy(zero_copy_only=False)[names]
                at, names = at[kept], names[kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _gathered(batches):
            yield from count(table.column(0).to_pylist(), table.column(1).to_numpy())

    rows = words.where(F.length("word") > 0).select("word", F.col("n").cast("bigint"))
    return rows.mapInArrow(run, "piece string, n bigint").groupBy("piece").agg(F.sum("n").alias("n"))


def seed_pieces(words: DataFrame, letters: list[str], size: int) -> dict[str, float]:
    """Starting scores: the letters and the best repeated substrings of the words.

    Short substrings are counted first. A longer one is at most as frequent as its
    beginning, so only those are counted whose beginning is frequent enough for a place
    among the best ``size``. At most ``size`` rows and the alphabet come to the driver.
    """
    spark = words.sparkSession
    value = F.col("n") * F.length("piece")
    several = (F.length("piece") > 1) & (F.col("n") > 1)
    short = materialize(_substrings(words, 1, BEGINNING), "short-pieces")
    ranked = short.where(several).orderBy(F.desc(value), "piece").limit(size)
    found = ranked.agg(F.count(F.lit(1)).alias("n"), F.min(value).alias("least")).first()
    least = found["least"] if found["n"] >= size and size > 0 else 0
    frequent = short.where(several & (F.length("piece") == BEGINNING) & (F.col("n") * MAX_PIECE >= least))
    begins = pa.concat_arrays([pa.array([], pa.string()), *(c.cast(pa.string()) for c in frequent.select("piece").toArrow().column(0).chunks)])
    longer = _substrings(words, BEGINNING + 1, MAX_PIECE, spark.sparkContext.broadcast(begins))
    known = set(letters)
    best = short.unionByName(longer).where(several & (value >= least)).orderBy(F.desc(value), "piece").limit(size).collect()
    singles = short.where(F.length("piece") == 1).join(
        F.broadcast(spark.createDataFrame([(c,) for c in letters], "piece string")), "piece"
    )
    counts = {r["piece"]: float(r["n"]) for r in singles.collect()}
    counts.update({r["piece"]: float(r["n"]) for r in best if set(r["piece"]) <= known})
    return _log_share(counts)


def _log_share(counts: dict[str, float]) -> dict[str, float]:
    total = math.log(sum(counts.values()))
    return {p: math.log(c) - total for p, c in counts.items() if c > 0}


def shared_trie(spark: SparkSession, model: dict[str, float]) -> Broadcast:
    """The pieces of ``model`` and their trie, for this model and those that are left of it."""
    pieces = list(model)
    return spark.sparkContext.broadcast((pieces, Trie(pieces)))


def expectation(words: DataFrame, model: dict[str, float], trie: Broadcast) -> dict[str, float]:
    """Expected piece counts over all words; one row per piece comes back."""
    shared = words.sparkSession.sparkContext.broadcast(model)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(shared.value, *trie.value)
        totals = np.zeros(len(lattice.scores))
        for table in _gathered(batches):
            totals += lattice.expected(table.column(0).to_pylist(), table.column(1).to_numpy().astype(float))
        seen = np.flatnonzero(totals[:-1])
        yield pa.RecordBatch.from_arrays([pa.array([lattice.pieces[i] for i in seen.tolist()], pa.string()), pa.array(totals[seen])], names=["piece", "n"])

    sums = words.select("word", F.col("n").cast("bigint")).mapInArrow(count, "piece string, n double").groupBy("piece").agg(F.sum("n").alias("n"))
    return {r["piece"]: r["n"] for r in sums.collect()}


def prune(spark: SparkSession, counts: dict[str, float], letters: list[str], size: int, trie: Broadcast) -> dict[str, float]:
    """Drop the pieces whose absence costs least; letters always stay.

    What the absence of a piece costs, its best split into others, is worked out in
    the tasks, over a table of the pieces.
    """
    model, kept = _log_share(counts), set(letters)
    others = [p for p in model if p not in kept]
    room = max(0, size - len(kept), int(len(others) * KEEP_SHARE))
    if room >= len(others):
        return counts
    shared = spark.sparkContext.broadcast(model)

    def losses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(shared.value, *trie.value)
        for batch in batches:
            pieces = batch.column(0).to_pylist()
            other = np.zeros(len(pieces))
            for rows, scores, _ in lattice.best(pieces, whole=False):
                other[rows] = scores
            own = np.array([shared.value[p] for p in pieces])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(batch.column(1).to_numpy() * (own - other))], names=["piece", "loss"])

    table = pa.table({"piece": pa.array(others, pa.string()), "n": pa.array([float(counts[p]) for p in others])})
    ranked = spread(spark.createDataFrame(table)).mapInArrow(losses, "piece string, loss double")
    best = ranked.orderBy(F.desc("loss"), "piece").limit(room).select("piece").toArrow().column("piece").to_pylist()
    stay = kept.union(best)
    return {p: n for p, n in counts.items() if p in stay}


def learn_unigram(words: DataFrame, letters: list[str], size: int, rounds: int = 2, seed_factor: int = SEED_FACTOR) -> dict[str, float]:
    """Piece scores of a vocabulary of ``size`` pieces, the alphabet included.

    There are fewer pieces only if the words have fewer repeated substrings to start
    from. Pieces that no likely split needs keep the least count, and are the first to
    go. The corpus-sized work, expected counts over the distinct words, runs in the
    tasks; the driver holds the model, whose size the parameters bound.
    """
    words = cut_lineage(spread(words))
    model = seed_pieces(words, letters, seed_factor * size)
    # letters that the words lack are pieces too
    least = min(model.values(), default=0.0)
    model = {**dict.fromkeys(letters, least), **model}
    trie = shared_trie(words.sparkSession, model)
    while True:
        counts: dict[str, float] = {}
        for _ in range(rounds):
            counts = expectation(words, model, trie)
            counts = {p: max(counts.get(p, 0.0), FLOOR) for p in {**dict.fromkeys(letters), **model}}
            model = _log_share(counts)
        if len(model) <= max(size, len(letters)):
            return model
        model = _log_share(prune(words.sparkSession, counts, letters, size, trie))


def model_table(spark, model: dict[str, float]) -> DataFrame:
    rows = sorted(model.items(), key=lambda x: (-x[1], x[0]))
    ids = [(i + len(vb.SPECIAL_PIECES) + 256, p, s) for i, (p, s) in enumerate(rows)]
    return spark.createDataFrame(ids, "id int, piece string, log_prob double")


def piece_ids(model: dict[str, float]) -> dict[str, int]:
    ordered = [p for p, _ in sorted(model.items(), key=lambda x: (-x[1], x[0]))]
    return bpe.piece_ids(ordered, [])


def encode(texts: DataFrame, model: dict[str, float], text: str = "text") -> DataFrame:
    """Adds ``ids`` by the likeliest split of each word, unknown characters in bytes."""
    shared = texts.sparkSession.sparkContext.broadcast((Lattice(model), piece_ids(model)))

    def make() -> codec.Coder:
        return coder(*shared.value)

    return texts.withColumn("ids", codec.ids_column(make)(vb.marked_words(F.col(text))))


def coder(lattice: Lattice, ids: dict[str, int]) -> codec.Coder:
    """Ids of the likeliest splits of many words."""
    numbers = np.array([*(ids[p] for p in lattice.pieces), -1])

    def code(words: list[str]) -> list[list[int]]:
        out: list[list[int]] = [[] for _ in words]
        for rows, _, pieces in lattice.best(words):
            first = (pieces < 0).sum(1).tolist()
            plain = ~(pieces == len(lattice.pieces)).any(1)
            for row, good, start, own, line in zip(rows.tolist(), plain.tolist(), first, pieces.tolist(), numbers[pieces].tolist()):
                out[row] = line[start:] if good else _spelled(words[row], own[start:], lattice, ids)
        return out

    return code


def _spelled(word: str, pieces: list[int], lattice: Lattice, ids: dict[str, int]) -> list[int]:
    """Ids of a split with characters that are no pieces, which are written in bytes."""
    parts, at = [], 0
    for p in pieces:
        part = lattice.pieces[p] if p < len(lattice.pieces) else word[at]
        parts.append(part)
        at += len(part)
    return bpe.fall_back(parts, ids)
