"""Byte-pair merges learnt over a stored table of words.

The words lie in the shared folder as lists of symbol numbers. A round reads them in Arrow
batches, applies the merges since they were last written, and hands on how the newest ones
change the counts of pairs; a merge works on a whole batch at once. Only the changes of a
round come to the driver, which holds the most frequent pairs in a heap and takes the next
merges from it.

Tasks keep nothing between rounds, so their memory is that of a batch and of the distinct
pairs that a round changes, and a lost worker costs no more than its tasks.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkstrata.session import materialize

# Symbols of a word are written between these two control characters.
OPEN, CLOSE = "\x02", "\x03"
# Pairs the driver knows the counts of, at least until the next full count.
KNOWN_PAIRS = 100_000
# Rounds after which the words are written anew.
REBASE = 16
# Words of a task that has a core to itself, and the most of any task.
PART_WORDS, MOST_WORDS = 20_000, 1_000_000
# Tasks from which on the changes are added up before they come to the driver.
MANY_TASKS = 64
# Pair counts that are added up at once.
HELD_COUNTS = 1 << 20
# Numbers of symbols: characters are code points, and merged ones follow.
CHARACTERS = 0x110000

Pair = tuple[str, str]
Ranked = tuple[str, str, int]
# Numbers of a pair and of the symbol it becomes.
Merge = tuple[int, int, int]


class Symbols:
    """Numbers of symbols, in the order in which they are made."""

    def __init__(self) -> None:
        self.made: dict[str, int] = {}

    def number(self, symbol: str) -> int:
        return ord(symbol) if len(symbol) == 1 else self.made[symbol]

    def merge(self, left: str, right: str) -> Merge:
        pair = self.number(left), self.number(right)
        return *pair, self.made.setdefault(left + right, CHARACTERS + len(self.made))


class Words:
    """A batch of words: their symbols one after the other, which of them end a word, and the counts of the words."""

    def __init__(self, batch: pa.RecordBatch):
        words = batch.column(0).cast(pa.large_binary())
        offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
        data = words.buffers()[2]
        self.symbols = np.frombuffer(data if data is not None else b"", np.uint8)[offsets[0] : offsets[-1]].view(np.int32)
        sizes = np.diff(offsets) // 4
        self.last = np.zeros(len(self.symbols), bool)
        self.last[np.cumsum(sizes) - 1] = True
        self.counts = np.repeat(batch.column(1).to_numpy(), sizes)

    def pairs(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys and counts of the pairs that begin at these places."""
        return self.symbols[at].astype(np.int64) << 32 | self.symbols[at + 1], self.counts[at]

    def all_pairs(self) -> tuple[np.ndarray, np.ndarray]:
        return self.pairs(np.flatnonzero(~self.last))

    def _around(self, at: np.ndarray, more: int) -> tuple[np.ndarray, np.ndarray]:
        """The pairs that meet the places ``at`` to ``at + more``, each once."""
        met = np.zeros(len(self.symbols), bool)
        met[at[at > 0] - 1] = True
        for by in range(more + 1):
            met[at + by] = True
        return self.pairs(np.flatnonzero(met & ~self.last))

    def merge(self, group: Group) -> tuple[np.ndarray, np.ndarray] | None:
        """Join the pairs of ``group`` wherever they meet; how that changes the counts of pairs."""
        at = np.flatnonzero(group.left[self.symbols[:-1]] & group.right[self.symbols[1:]] & ~self.last[:-1])
        keys, _ = self.pairs(at)
        place = np.minimum(np.searchsorted(group.keys, keys), len(group.keys) - 1)
        found = group.keys[place] == keys
        at, place = at[found], place[found]
        if group.double and len(at):
            # of a run of equal symbols every other pair, from the left; words have runs of their own
            first = np.r_[True, np.diff(at) != 1]
            run = np.flatnonzero(first)[np.cumsum(first) - 1]
            even = (np.arange(len(at)) - run) % 2 == 0
            at, place = at[even], place[even]
        if not len(at):
            return None
        lost, lost_counts = self._around(at, 1)
        keep = np.ones(len(self.symbols), bool)
        keep[at + 1] = False
        symbols, last = self.symbols.copy(), self.last.copy()
        symbols[at], last[at] = group.made[place], last[at + 1]
        self.symbols, self.last, self.counts = symbols[keep], last[keep], self.counts[keep]
        won, won_counts = self._around(at - np.arange(len(at)), 0)
        return np.concatenate([lost, won]), np.concatenate([-lost_counts, won_counts])


class Group:
    """Merges that do not touch each other, so that they can be applied at once."""

    def __init__(self, merges: list[Merge], symbols: int):
        found = np.array(sorted((left << 32 | right, made) for left, right, made in merges), np.int64)
        self.keys, self.made = found[:, 0], found[:, 1].astype(np.int32)
        self.double = any(left == right for left, right, _ in merges)
        self.left, self.right = np.zeros(symbols, bool), np.zeros(symbols, bool)
        self.left[[left for left, *_ in merges]] = True
        self.right[[right for _, right, _ in merges]] = True


def grouped(merges: list[Merge], made: list[str]) -> list[Group]:
    """``merges`` in groups; ``made`` are all symbols made so far."""
    return [Group(group, CHARACTERS + len(made)) for group in in_groups(merges)]


def in_groups(merges: list[Merge]) -> Iterator[list[Merge]]:
    """Runs of merges that give the same at once as one after the other."""
    group: list[Merge] = []
    lefts, rights, made = set(), set(), set()
    for left, right, joined in merges:
        meets = left in rights or right in lefts or left in made or right in made
        if group and (meets or left == right or group[-1][0] == group[-1][1]):
            yield group
            group, lefts, rights, made = [], set(), set(), set()
        group.append((left, right, joined))
        lefts.add(left)
        rights.add(right)
        made.add(joined)
    if group:
        yield group


class _Sums:
    """Counts by pair, added up from time to time."""

    def __init__(self) -> None:
        self.keys, self.counts, self.held = [], [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys.append(keys)
        self.counts.append(counts)
        self.held += len(keys)
        if self.held >= HELD_COUNTS:
            keys, _ = self.total()
            # as many again before the next time, so that each is sorted a few times at most
            self.held = min(0, HELD_COUNTS - len(keys))

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        keys = np.concatenate([np.zeros(0, np.int64), *self.keys])
        counts = np.concatenate([np.zeros(0, np.int64), *self.counts])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])
        counts = np.add.reduceat(counts, first) if len(keys) else counts
        self.keys, self.counts = [keys[first]], [counts]
        return self.keys[0], counts

    def rows(self, made: list[str]) -> Iterator[pa.RecordBatch]:
        keys, counts = self.total()
        changed = counts != 0
        keys, counts = keys[changed], counts[changed]

        def names(numbers: np.ndarray) -> pa.Array:
            distinct, places = np.unique(numbers, return_inverse=True)
            spelled = [chr(x) if x < CHARACTERS else made[x - CHARACTERS] for x in distinct.tolist()]
            return pa.array(spelled, pa.string()).take(pa.array(places))

        for at in range(0, len(keys), HELD_COUNTS):
            part = keys[at : at + HELD_COUNTS]
            columns = [names(part >> 32), names(part & 0xFFFFFFFF), pa.array(counts[at : at + HELD_COUNTS])]
            yield pa.RecordBatch.from_arrays(columns, names=["left", "right", "n"])


_PAIRS = "left string, right string, n bigint"
_WORDS = "symbols binary, n bigint"


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words as the code points of their symbols."""
    for batch in batches:
        words, n = batch.column(0).cast(pa.string()), batch.column(1)
        plain = pc.replace_substring(pc.replace_substring(words, OPEN, ""), CLOSE, "")
        sizes = pc.utf8_length(plain).to_numpy().astype(np.int64)
        if (pc.utf8_length(words).to_numpy() != 3 * sizes).any():
            raise ValueError("words begin as single characters")
        data = "".join(plain.to_pylist()).encode("utf-32-le")
        offsets = pa.py_buffer(np.r_[0, np.cumsum(4 * sizes)].astype(np.int32).tobytes())
        numbers = pa.Array.from_buffers(pa.binary(), len(words), [None, offsets, pa.py_buffer(data)])
        yield pa.RecordBatch.from_arrays([numbers, n], names=["symbols", "n"])


def _all_counts(merges: list[Merge], made: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, sums = grouped(merges, made), _Sums()
        for batch in batches:
            words = Words(batch)
            for group in groups:
                words.merge(group)
            sums.add(*words.all_pairs())
        yield from sums.rows(made)

    return run


def _changes(merges: list[Merge], since: int, made: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, latest = grouped(merges[:since], made), grouped(merges[since:], made)
        sums = _Sums()
        for batch in batches:
            words = Words(batch)
            for group in before:
                words.merge(group)
            for group in latest:
                changed = words.merge(group)
                if changed is not None:
                    sums.add(*changed)
        yield from sums.rows(made)

    return run


def _merged(merges: list[Merge], made: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The words after ``merges``; those of one symbol have no pairs any more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = grouped(merges, made)
        for batch in batches:
            words = Words(batch)
            for group in groups:
                words.merge(group)
            ends = np.flatnonzero(words.last)
            sizes = np.diff(np.r_[-1, ends])
            offsets = pa.py_buffer(np.r_[0, 4 * (ends + 1)].astype(np.int32).tobytes())
            numbers = pa.Array.from_buffers(pa.binary(), len(ends), [None, offsets, pa.py_buffer(np.ascontiguousarray(words.symbols).tobytes())])
            left = pa.RecordBatch.from_arrays([numbers, pa.array(words.counts[ends])], names=["symbols", "n"])
            yield left.filter(pa.array(sizes > 1))

    return run


class Queue:
    """The most frequent pairs with their exact counts, and up to where they are all known.

    ``bound`` is the order key of the first pair that is not known, if there is one.
    Counts of pairs that are not known can grow only through a symbol that was there
    before; ``rising`` holds by how much. A pair with a symbol made since is new, so
    its count is all its changes.
    """

    def __init__(self, rows: list[Ranked], known: int, min_count: int, symbols: set[str]):
        self.counts = {(left, right): n for left, right, n in rows[:known]}
        self.heap = [(-n, left, right) for left, right, n in rows[:known]]
        heapq.heapify(self.heap)
        self.min_count, self.symbols, self.made = min_count, symbols, set()
        self.bound = None
        if len(rows) > known:
            left, right, n = rows[known]
            self.bound = (-n, left, right)
        self.rising: Counter[Pair] = Counter()

    def change(self, pair: Pair, by: int) -> None:
        if pair in self.counts or pair[0] in self.made or pair[1] in self.made:
            self.counts[pair] = n = self.counts.get(pair, 0) + by
            if n >= self.min_count:
                heapq.heappush(self.heap, (-n, *pair))
        else:
            self.rising[pair] += by

    def made_symbol(self, symbol: str) -> None:
        if symbol not in self.symbols:
            self.made.add(symbol)

    def first(self, count: int) -> list[Ranked]:
        """The leading pairs, at most ``count``, no further than is certain."""
        least = self.min_count - 1 if self.bound is None else -self.bound[0]
        unsure = max((least + by for by in self.rising.values() if by > 0), default=0)
        out: list[Ranked] = []
        seen: set[Pair] = set()
        while self.heap and len(out) < count:
            key = self.heap[0]
            pair = (key[1], key[2])
            if pair in seen or self.counts[pair] != -key[0]:
                heapq.heappop(self.heap)
                continue
            if self.bound is not None and key > self.bound or -key[0] <= unsure:
                break
            heapq.heappop(self.heap)
            seen.add(pair)
            out.append((*pair, -key[0]))
        for left, right, n in out:
            heapq.heappush(self.heap, (-n, left, right))
        return out

    @property
    def complete(self) -> bool:
        """No pair but those that are known can be merged."""
        return self.bound is None and not any(by > 0 for by in self.rising.values())


def learn(
    start: DataFrame,
    merges: int,
    choose: Callable[[list[Ranked]], list[Ranked]],
    per_round: int,
    min_count: int,
    known: int = KNOWN_PAIRS,
) -> list[Ranked]:
    """The first ``merges`` merges of ``start`` (``symbols, n``), best pair first.

    Symbols of ``start`` are characters. ``choose`` takes ranked pairs and returns the
    leading ones that may be merged in one round. At most ``known`` pairs and the changes
    of a round come to the driver; once the next pair is not certain from them, all pairs
    are counted again.
    """
    spark = start.sparkSession
    # a word of one symbol has no pairs
    several = start.where(F.contains("symbols", F.lit(CLOSE + OPEN)))
    table = materialize(several.mapInArrow(_numbered, _WORDS), "words")
    number = table.count()
    tasks = max(1, min(spark.sparkContext.defaultParallelism, -(-number // PART_WORDS)), -(-number // MOST_WORDS))
    table = materialize(table.repartition(tasks), "words")
    names, pending, rounds, learnt = Symbols(), [], 0, []
    queue: Queue | None = None
    while len(learnt) < merges:
        ranked = queue.first(per_round + 1) if queue else []
        if not ranked:
            if queue and queue.complete:
                break
            counted = table.mapInArrow(_all_counts(list(pending), list(names.made)), _PAIRS)
            summed = counted.groupBy("left", "right").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
            rows = summed.orderBy(F.desc("n"), "left", "right").limit(known + 1).collect()
            queue = Queue([tuple(r) for r in rows], known, min_count, {left + right for left, right, _ in learnt})
            ranked = queue.first(per_round + 1)
            if not ranked:
                break
        chosen = choose(ranked)
        if len(ranked) > per_round:
            # the last candidate only shows whether there is a tie at the end
            last = ranked[per_round][2]
            chosen = chosen[:per_round]
            while len(chosen) > 1 and chosen[-1][2] == last:
                chosen.pop()
        chosen = chosen[: merges - len(learnt)]
        learnt += chosen
        if len(learnt) >= merges:
            break
        since = len(pending)
        pending += [names.merge(left, right) for left, right, _ in chosen]
        for left, right, _ in chosen:
            queue.made_symbol(left + right)
        changed = table.mapInArrow(_changes(list(pending), since, list(names.made)), _PAIRS)
        if tasks > MANY_TASKS:
            changed = changed.groupBy("left", "right").agg(F.sum("n").alias("n"))
        total: Counter[Pair] = Counter()
        for left, right, n in changed.collect():
            total[left, right] += n
        for pair, by in total.items():
            if by:
                queue.change(pair, by)
        rounds += 1
        if rounds % REBASE == 0:
            table = materialize(table.mapInArrow(_merged(list(pending), list(names.made)), _WORDS), "words")
            pending = []
    return learnt
