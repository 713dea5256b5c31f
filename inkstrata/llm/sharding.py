"""Equal-bytes sharding by histogram sort.

Rows are ordered by a hash of their text, then by a hash of the row, so equal
texts lie next to each other and a large group of them can still be cut, down to
copies of one row. The
boundaries between shards are found without sorting: each round counts the exact
bytes and rows between probes in one pass over the narrow key table, keeps for
every boundary the one interval that holds it, and puts new probes there, until
the bytes below a boundary are within the tolerance or a single row remains. Then
the rows are exchanged once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkstrata.session import materialize

SHARDS = 40
OVERHEAD = 16
# Allowed error of a boundary, as a share of a shard's bytes.
TOLERANCE = 0.001
# Bytes of a cell, which one task numbers.
CELL_BYTES = 64 << 20
# New probes for each boundary and round.
PROBES = 16

_LOW, _HIGH = -(2**63), 2**63 - 1
Key = tuple[int, int]


def size_of(text: Column) -> Column:
    """UTF-8 bytes of a text and ``OVERHEAD``; a null text counts no bytes."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + OVERHEAD


def checksum_of(text: Column) -> Column:
    return F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8"))


def with_keys(docs: DataFrame) -> DataFrame:
    """``row`` (all columns of ``docs``), ``size``, ``key`` and ``tie``.

    The tie is a hash of the row, so that only rows equal in all columns share it.
    Columns that hold maps have no hash and are left out of it.
    """
    hashed = [f.name for f in docs.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    columns = [F.col(f"`{name}`") for name in docs.columns]
    return docs.select(
        F.struct(*columns).alias("row"),
        size_of(F.col("text")).alias("size"),
        F.xxhash64("text").alias("key"),
        F.xxhash64(*[F.col(f"`{name}`") for name in hashed]).alias("tie"),
    )


def rank(bounds: list[Key], keys: np.ndarray, ties: np.ndarray) -> np.ndarray:
    """For each row the number of sorted ``bounds`` that are not above it."""
    first = np.fromiter((b[0] for b in bounds), dtype=np.int64, count=len(bounds))
    second = np.fromiter((b[1] for b in bounds), dtype=np.int64, count=len(bounds))
    low, high = np.searchsorted(first, keys, "left"), np.searchsorted(first, keys, "right")
    out = low.copy()
    shared = np.flatnonzero(low < high)
    if len(shared):
        for start in np.unique(low[shared]):
            rows = shared[low[shared] == start]
            end = high[rows[0]]
            out[rows] = start + np.searchsorted(second[start:end], ties[rows], "right")
    return out


def _count(bounds: list[Key]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = len(bounds) + 1
        size, rows = np.zeros(cells, np.int64), np.zeros(cells, np.int64)
        ends = {"key": (np.full(cells, _HIGH), np.full(cells, _LOW)), "tie": (np.full(cells, _HIGH), np.full(cells, _LOW))}
        for batch in batches:
            keys, ties, sizes = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            at = rank(bounds, keys, ties)
            np.add.at(size, at, sizes)
            rows += np.bincount(at, minlength=cells)
            for values, (least, most) in ((keys, ends["key"]), (ties, ends["tie"])):
                np.minimum.at(least, at, values)
                np.maximum.at(most, at, values)
        seen = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (seen, size[seen], rows[seen], *(e[seen] for pair in ends.values() for e in pair))],
            names=["cell", "bytes", "n", "key_min", "key_max", "tie_min", "tie_max"],
        )

    return run


_COUNTS = "cell bigint, bytes bigint, n bigint, key_min bigint, key_max bigint, tie_min bigint, tie_max bigint"


@dataclass
class _Interval:
    """Rows between two keys that hold a boundary; below: bytes and rows before them."""

    key: tuple[int, int]
    tie: tuple[int, int]
    below: int
    rows_below: int
    bytes: int
    rows: int

    @property
    def in_group(self) -> bool:
        return self.key[0] == self.key[1]

    @property
    def single(self) -> bool:
        return self.in_group and self.tie[0] == self.tie[1]

    def start(self) -> Key:
        return (self.key[0], self.tie[0] if self.in_group else _LOW)

    def end(self) -> Key:
        """A key above every row of the interval and not above any later row."""
        if not self.in_group:
            return (self.key[1], _HIGH)
        return (self.key[1], min(self.tie[1] + 1, _HIGH))

    def probes(self, count: int) -> list[Key]:
        low, high = self.tie if self.in_group else self.key
        values = sorted({low + (high - low) * i // (count + 1) for i in range(1, count + 1)} - {low})
        return [(self.key[0], v) if self.in_group else (v, _LOW) for v in [*values, high] if v > low]


@dataclass(frozen=True)
class Boundary:
    """A key with the bytes and rows below it; ``inside`` are the rows of that very key that are below."""

    key: Key
    bytes_below: int
    rows_below: int
    inside: int = 0


def splitters(keys: DataFrame, parts: int, tolerance: float) -> list[Boundary]:
    """``parts - 1`` boundaries of ``keys`` (``key, tie, size``) into parts of equal bytes.

    A boundary in a group of equal rows is put between two of them.

    The driver holds the probes and their counts only, ``PROBES`` for each open
    boundary. ``tolerance`` is in bytes.
    """
    narrow = keys.select("key", "tie", "size")

    def counted(bounds: list[Key]) -> dict[int, tuple]:
        sums = narrow.mapInArrow(_count(bounds), _COUNTS).groupBy("cell").agg(
            *[F.sum(c).alias(c) for c in ("bytes", "n")],
            *[getattr(F, c.split("_")[1])(c).alias(c) for c in ("key_min", "key_max", "tie_min", "tie_max")],
        )
        return {r["cell"]: r for r in sums.collect()}

    def interval(r, below: int, rows_below: int) -> _Interval:
        return _Interval((r["key_min"], r["key_max"]), (r["tie_min"], r["tie_max"]), below, rows_below, r["bytes"], r["n"])

    whole = counted([])
    if not whole:
        return []
    every = interval(whole[0], 0, 0)
    open_: dict[int, _Interval] = {i: every for i in range(1, parts)}
    targets = {i: every.bytes * i // parts for i in open_}
    done: dict[int, Boundary] = {}
    while open_:
        sharing: dict[int, list[int]] = {}
        for i, x in open_.items():
            sharing.setdefault(id(x), []).append(i)
        bounds: set[Key] = set()
        for members in sharing.values():
            x = open_[members[0]]
            bounds.update([x.start(), x.end(), *x.probes(PROBES * len(members))])
        ordered = sorted(bounds)
        counts = counted(ordered)
        for members in sharing.values():
            x = open_[members[0]]
            below, rows_below = x.below, x.rows_below
            parts_of = []
            for cell in range(ordered.index(x.start()) + 1, ordered.index(x.end()) + 1):
                if cell in counts:
                    parts_of.append(interval(counts[cell], below, rows_below))
                    below, rows_below = below + counts[cell]["bytes"], rows_below + counts[cell]["n"]
            for i in members:
                target = targets[i]
                part = next((p for p in parts_of if p.below + p.bytes >= target), parts_of[-1])
                before, after = abs(target - part.below), abs(part.below + part.bytes - target)
                if part.single and 0 < before and 0 < after:
                    # equal rows have equal bytes
                    each = part.bytes // part.rows
                    inside = min(part.rows, (2 * before + each) // (2 * each))
                    if 0 < inside < part.rows:
                        done[i] = Boundary(part.start(), part.below + inside * each, part.rows_below + inside, inside)
                        del open_[i]
                        continue
                if min(before, after) > tolerance and not part.single:
                    open_[i] = next((o for o in open_.values() if o.start() == part.start() and o.end() == part.end() and o.below == part.below), part)
                    continue
                if before <= after:
                    done[i] = Boundary(part.start(), part.below, part.rows_below)
                else:
                    done[i] = Boundary(part.end(), part.below + part.bytes, part.rows_below + part.rows)
                del open_[i]
    return [done[i] for i in sorted(done)]


def shard(
    docs: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE, shard_column: str = "shard", slot_column: str = "slot"
) -> DataFrame:
    """``docs`` with the number of its shard and a gapless place from 0 in it.

    Shards are equal in bytes up to ``tolerance`` of a shard, or to the one row that a
    boundary falls in. Rows equal in all columns are cut between any two of them: such a
    group is counted, and its copies are dealt to their places. A null text counts no
    bytes. ``docs`` may have columns of any names but ``shard_column`` and
    ``slot_column``, which is an error. An empty table gives no rows.

    A shard is made of several cells of at most about ``CELL_BYTES``, so that no task
    numbers a whole shard.
    """
    for name in (shard_column, slot_column):
        if name.lower() in (c.lower() for c in docs.columns):
            raise ValueError(f"there is a column {name!r} already; give the new one another name")
    keyed = with_keys(docs)
    keys = materialize(keyed.select("key", "tie", "size"), "shard-keys")
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = keys.agg(F.sum("size")).first()[0] or 0
    per_shard = max(1, -(-2 * tasks // shards), -(-total // (shards * CELL_BYTES)))
    found = splitters(keys, shards * per_shard, tolerance * total / shards / 2)
    bounds = [b.key for b in found]
    # rows before each cell in its shard
    rows_below = [0, *(b.rows_below for b in found)]
    ahead = [rows_below[i] - rows_below[i // per_shard * per_shard] for i in range(len(rows_below))]

    @F.pandas_udf("int")
    def cell_of(key: pd.Series, tie: pd.Series) -> pd.Series:
        return pd.Series(rank(bounds, key.to_numpy(), tie.to_numpy()).astype(np.int32))

    def listed(values: list[int]) -> Column:
        return F.element_at(F.array(*[F.lit(x).cast("bigint") for x in values]), F.col("cell") + 1)

    def named(rows: DataFrame) -> DataFrame:
        fields = [F.col("row").getField(name).alias(name) for name in docs.columns]
        return rows.select(*fields, F.floor(F.col("cell") / per_shard).cast("int").alias(shard_column), F.col("slot").alias(slot_column))

    # cells of each cut group: their rows of it, and how many come before them in the cell's shard
    cut: dict[Key, list[tuple[int, int, int]]] = {}
    lead = [0] * len(rows_below)
    group_ends = {b.key: 0 for b in found if b.inside}
    if group_ends:
        sizes = keys.where(F.struct("key", "tie").isin([F.struct(F.lit(k).cast("bigint"), F.lit(t).cast("bigint")) for k, t in group_ends]))
        group_ends = {(r["key"], r["tie"]): r["n"] for r in sizes.groupBy("key", "tie").agg(F.count(F.lit(1)).alias("n")).collect()}
    for key, rows in group_ends.items():
        at = [(i, b.inside) for i, b in enumerate(found) if b.key == key and b.inside]
        start = at[0][0]
        first_row = found[start].rows_below - at[0][1]
        edges = [0, *(inside for _, inside in at), rows]
        cut[key] = []
        for step, (low, high) in enumerate(zip(edges, edges[1:])):
            cell = start + step
            if high > low:
                cut[key].append((cell, high - low, ahead[cell] + first_row + low - rows_below[cell]))
                if step:
                    lead[cell] = high - low
    is_cut = F.lit(False)
    for key, tie in cut:
        is_cut = is_cut | ((F.col("key") == key) & (F.col("tie") == tie))

    placed = keyed.where(~is_cut).withColumn("cell", cell_of("key", "tie"))
    within = Window.partitionBy("cell").orderBy("key", "tie")
    out = named(placed.withColumn("slot", F.row_number().over(within).cast("bigint") - 1 + listed(ahead) + listed(lead)))
    if cut:
        shares = [(key, tie, cell, n, slot) for (key, tie), own in cut.items() for cell, n, slot in own]
        table = docs.sparkSession.createDataFrame(shares, "key bigint, tie bigint, cell int, copies bigint, first bigint")
        # one row stands for all of its group, and is copied in the tasks of its cells
        one = keyed.where(is_cut).groupBy("key", "tie").agg(F.first("row").alias("row"))
        dealt = one.join(F.broadcast(table), ["key", "tie"]).repartition(tasks, "cell")
        copies = dealt.withColumn("slot", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("copies") - 1)))
        out = out.unionByName(named(copies))
    return out


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, shard_column: str = "shard", slot_column: str = "slot") -> None:
    """Write ``docs`` to ``path/shard=N``, with the places in the files."""
    shard(docs, shards, shard_column=shard_column, slot_column=slot_column).write.partitionBy(shard_column).parquet(path)
