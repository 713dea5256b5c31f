"""Byte-pair vocabularies learnt over a word-count table."""

from __future__ import annotations

from collections.abc import Iterable
from heapq import heapify, heappop, heappush

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkstrata.functions import text as tx
from inkstrata.operators import codec, pairs
from inkstrata.operators import vocabulary as vb
from inkstrata.operators.pairs import CLOSE, OPEN

# Control characters, which are no part of any piece.
CONTROLS = r"[\x01-\x08\x0b\x0e-\x1f\x7f]"


def start_symbols(words: DataFrame) -> DataFrame:
    """``symbols, n``: every word as its characters."""
    letters = tx.characters(F.regexp_replace("word", CONTROLS, ""))
    return words.select(
        F.concat(F.lit(OPEN), F.array_join(letters, CLOSE + OPEN), F.lit(CLOSE)).alias("symbols"), "n"
    )


def _symbol_list(symbols: Column) -> Column:
    return F.split(F.substring(symbols, F.lit(2), F.length(symbols) - 2), CLOSE + OPEN)


def count_pairs(words: DataFrame) -> DataFrame:
    """``left, right, n``: adjacent symbols, weighted by the count of the word."""

    def neighbours(parts: Column) -> Column:
        return F.arrays_zip(
            F.slice(parts, F.lit(1), F.size(parts) - 1).alias("left"),
            F.slice(parts, F.lit(2), F.size(parts) - 1).alias("right"),
        )

    split = words.select(_symbol_list(F.col("symbols")).alias("parts"), "n").where(F.size("parts") > 1)
    return (
        split.select(F.explode(neighbours(F.col("parts"))).alias("pair"), "n")
        .groupBy(F.col("pair.left").alias("left"), F.col("pair.right").alias("right"))
        .agg(F.sum("n").alias("n"))
    )


def independent_prefix(ranked: list[tuple[str, str, int]]) -> list[tuple[str, str, int]]:
    """The leading pairs that one-at-a-time merging would pick in this very order.

    A merge changes only counts of pairs that meet it in a word: those that begin with
    its right symbol or end with its left one. A pair it brings about is no more
    frequent than such a neighbour. So pairs can be merged together up to the first
    one that meets an earlier one; a tie with that one is left for the next round.
    """
    taken: list[tuple[str, str, int]] = []
    lefts: set[str] = set()
    rights: set[str] = set()
    for left, right, n in ranked:
        if left in rights or right in lefts or left == right and taken:
            while len(taken) > 1 and taken[-1][2] == n:
                taken.pop()
            break
        taken.append((left, right, n))
        lefts.add(left)
        rights.add(right)
        if left == right:
            break
    return taken


def learn_merges(words: DataFrame, merges: int, per_round: int = 32, min_count: int = 2) -> list[tuple[str, str, int]]:
    """The first ``merges`` merges as ``(left, right, count)``, best pair first.

    Ties go to the smaller pair. The words stay in the tasks, where a merge touches
    those that hold its pair; a round merges as many pairs as one-at-a-time learning
    would have picked next, whatever the other merges of the round change.
    """
    return pairs.learn(start_symbols(words), merges, independent_prefix, per_round, min_count)


def merge_table(spark, learnt: list[tuple[str, str, int]]) -> DataFrame:
    rows = [(i, left, right, n) for i, (left, right, n) in enumerate(learnt, start=1)]
    return spark.createDataFrame(rows, "rank int, left string, right string, n bigint")


def piece_ids(letters: list[str], learnt: list[tuple[str, str, int]]) -> dict[str, int]:
    """Ids: special pieces, the 256 byte pieces, the alphabet, the merges in order."""
    pieces = [*vb.SPECIAL_PIECES, *(f"<0x{b:02X}>" for b in range(256)), *letters]
    pieces += [left + right for left, right, _ in learnt]
    ids: dict[str, int] = {}
    for piece in pieces:
        ids.setdefault(piece, len(ids))
    return ids


def split_word(word: str, ranks: dict[tuple[str, str], int]) -> list[str]:
    """Apply the learnt merges to one word, lowest rank first.

    The parts are a linked list, and the places of pairs wait in a heap, so a long
    word costs as many steps as it has merges. All places of one rank are merged,
    from left to right, before the pairs that come about are looked at.
    """
    parts: list[str | None] = list(word)
    after = [*range(1, len(parts)), -1]
    before = list(range(-1, len(parts) - 1))
    waiting = [(ranks[pair], i) for i, pair in enumerate(zip(word, word[1:])) if pair in ranks]
    heapify(waiting)
    while waiting:
        rank, made = waiting[0][0], []
        while waiting and waiting[0][0] == rank:
            _, i = heappop(waiting)
            j = after[i]
            # a place may have been merged away, or hold other parts by now
            if parts[i] is None or j < 0 or ranks.get((parts[i], parts[j])) != rank:
                continue
            parts[i], parts[j] = parts[i] + parts[j], None
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            made.append(i)
        for i in made:
            for left in (before[i], i):
                if left >= 0 and parts[left] is not None and after[left] >= 0:
                    found = ranks.get((parts[left], parts[after[left]]))
                    if found is not None:
                        heappush(waiting, (found, left))
    return [part for part in parts if part is not None]


def fall_back(parts: list[str], ids: dict[str, int]) -> list[int]:
    """Ids of pieces; a piece the vocabulary lacks is written in bytes."""
    out: list[int] = []
    for part in parts:
        if part in ids:
            out.append(ids[part])
        else:
            out += [ids[f"<0x{b:02X}>"] for b in part.encode("utf-8")]
    return out


def encode(texts: DataFrame, letters: list[str], learnt: list[tuple[str, str, int]], text: str = "text") -> DataFrame:
    """Adds ``ids``. The model is broadcast; its size is that of the vocabulary."""
    model = texts.sparkSession.sparkContext.broadcast(
        ({(left, right): i for i, (left, right, _) in enumerate(learnt)}, piece_ids(letters, learnt))
    )

    def make() -> codec.Coder:
        ranks, ids = model.value
        return lambda words: [fall_back(split_word(word, ranks), ids) for word in words]

    return texts.withColumn("ids", codec.ids_column(make)(vb.marked_words(F.col(text))))


def decode_column(ids: Column, piece_to_id: dict[str, int]) -> Column:
    """Text of id lists, with white space unified as encoding does."""
    pieces = {i: p for p, i in piece_to_id.items()}

    @F.pandas_udf("string")
    def to_text(batch: pd.Series) -> pd.Series:
        return batch.map(lambda row: decode(row, pieces))

    return to_text(ids)


def decode(ids: Iterable[int], pieces: dict[int, str]) -> str:
    parts = []
    for i in ids:
        piece = pieces[i]
        parts.append(bytes([int(piece[3:5], 16)]) if piece.startswith("<0x") and len(piece) == 6 else piece.encode("utf-8"))
    return b"".join(parts).decode("utf-8").replace(vb.SPACE_MARK, " ").removeprefix(" ")
