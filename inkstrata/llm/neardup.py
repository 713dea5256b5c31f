"""Near-duplicate documents: b-bit MinHash signatures and a multi-index Hamming join.

A signature has 72 symbols of 11 bits in 12 chunks of 6. Two signatures that differ
in at most 23 symbols have, by pigeonhole, a chunk with at most one difference; so
each document is filed once for every chunk and every symbol left out of it, and all
pairs within that distance share a file (a pair of similarity 0.8 differs in 14 on
average and misses every file with a chance of 3 in a million). Pairs from the files
are confirmed on the full shingle sets.

Documents with equal sets are one node. In a file only pairs with its least member
are tried, which settles ordinary groups of copies with one pair per member. What is
then in another component than others of its file, such as a copy that was edited too
much, is compared with whole components: those that have one of its rarest shingles
too, early enough for a link to be possible. (In a common order of the shingles, sets
that are similar enough share one of their first fifth.) Blocks of asking documents
meet blocks of members there. So no link is lost, members of one component are never
compared with each other, and no row stands for a single pair.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkstrata.llm.common import hold, join_totals, releasing, schema_with, slices, texts_of
from inkstrata.llm.components import connected_components
from inkstrata.operators.skew import hot_keys, largest_keys, lookup_join, partitions
from inkstrata.session import cut_lineage, materialize

SHINGLE = 2
CHUNKS, CHUNK = 12, 6
SYMBOLS = CHUNKS * CHUNK
BITS = 11
# Signatures further apart are not compared in full (similarity 0.8: 14.4 +- 3.4).
MAX_DISTANCE = 32
# Bytes of shingle sets in a block, about.
BLOCK_BYTES = 1 << 20
# Nodes of a task that files them; each has a row for every symbol.
FILED_NODES = 8_192
# A table of at most so many ids is given to every task instead of shuffling texts.
SMALL_IDS = 2_000_000
_WORDS_KEPT = 65_536

_ODD = np.random.default_rng(6).integers(0, 2**63, SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xBF58476D1CE4E5B9)


class _WordHashes(dict):
    """64-bit hashes of words, kept while they are few."""

    def __missing__(self, word: bytes) -> int:
        value = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        if len(self) < _WORDS_KEPT:
            self[word] = value
        return value


_words = _WordHashes()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _C
    return x ^ (x >> np.uint64(31))


def shingles(text: str, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``size`` words, or of all words if they are fewer."""
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(_words.__getitem__, words), dtype=np.uint64, count=len(words))
    width = min(size, len(words))
    runs = np.full(len(words) - width + 1, width, dtype=np.uint64)
    for at in range(width):
        runs = _mixed(runs * _A + hashes[at : len(hashes) - width + 1 + at] * _B)
    return np.unique(runs)


def signature(values: np.ndarray) -> np.ndarray:
    """``SYMBOLS`` symbols of ``BITS`` bits from the least values of as many hash functions."""
    least = np.full(SYMBOLS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(values), 1024):
        np.minimum(least, (_ODD[:, None] * values[None, at : at + 1024]).min(axis=1), out=least)
    return (_mixed(least * _A) >> np.uint64(64 - BITS)).astype("<u2")


def _sign(size: int, with_row: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("neardup", _words.clear)
        for batch in slices(batches):
            counts, digests, signatures = [], [], []
            for text in texts_of(batch.column(1)):
                values = shingles(text, size)
                counts.append(len(values))
                # texts without words are no node: a null is no hot key
                digests.append(hashlib.blake2b(values.tobytes(), digest_size=16).digest() if len(values) else None)
                signatures.append(signature(values).tobytes() if len(values) else None)
            kept = [batch.column(0)] + ([batch.column(2)] if with_row else [])
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), pa.array(signatures, pa.binary())],
                names=["doc_id"] + ["row"] * with_row + ["n", "digest", "sig"],
            )

    return run


def _file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The keys a node is filed under: chunk and symbol left out, then the other symbols."""
    for batch in batches:
        if not batch.num_rows:
            continue
        nodes = batch.column(0).to_numpy()
        symbols = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype="<u2").reshape(-1, CHUNKS, CHUNK).astype(np.int64)
        for chunk in range(CHUNKS):
            for out in range(CHUNK):
                keys = np.full(len(nodes), chunk * CHUNK + out, dtype=np.int64)
                for at in range(CHUNK):
                    if at != out:
                        keys = keys << BITS | symbols[:, chunk, at]
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(nodes)], names=["key", "node"])


def _sets(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("neardup", _words.clear)
        for batch in slices(batches):
            values = [shingles(text, size) for text in texts_of(batch.column(0))]
            digests = [hashlib.blake2b(v.tobytes(), digest_size=16).digest() for v in values]
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array([v.tobytes() for v in values], pa.binary())], names=["digest", "values"])

    return run


def _compare(threshold: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One link at most for each asking document and block of members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for row in range(batch.num_rows):
                (asking, asking_sets), (members, sets) = (batch.column(i)[row].values.flatten() for i in (0, 1))
                sizes = pc.binary_length(sets).to_numpy(zero_copy_only=False).astype(np.int64) // 8
                starts, joined = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(sets.to_pylist()), np.uint64)
                for node, values in zip(asking.to_pylist(), asking_sets):
                    own = np.frombuffer(values.as_buffer(), np.uint64)
                    at = np.minimum(np.searchsorted(own, joined), len(own) - 1)
                    common = np.add.reduceat((own[at] == joined).astype(np.int64), starts)
                    near = np.flatnonzero(100 * common >= threshold * (len(own) + sizes - common))
                    if len(near):
                        found.append((node, members[int(near[0])].as_py()))
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return run


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each shingle of a set."""
    for batch in slices(batches):
        values = [np.frombuffer(v, np.int64) for v in batch.column(2).to_pylist()]
        sizes = np.fromiter(map(len, values), dtype=np.int64, count=len(values))
        rows = pa.array(np.repeat(np.arange(len(values)), sizes))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(values)), batch.column(0).take(rows), batch.column(1).take(rows), pa.array(np.repeat(sizes, sizes))],
            names=["shingle", "node", "component", "n"],
        )


@F.pandas_udf(T.IntegerType())
def _distance(a: pd.Series, b: pd.Series) -> pd.Series:
    x = np.frombuffer(b"".join(a), dtype="<u2").reshape(-1, SYMBOLS)
    y = np.frombuffer(b"".join(b), dtype="<u2").reshape(-1, SYMBOLS)
    return pd.Series((x != y).sum(axis=1).astype(np.int32))


@F.pandas_udf(T.LongType())
def _common(a: pd.Series, b: pd.Series) -> pd.Series:
    """Size of the intersection of two sorted sets."""
    return pd.Series([len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True)) for x, y in zip(a, b)], dtype="int64")


def _near(df: DataFrame, ids: DataFrame, on: str) -> DataFrame:
    """Rows of ``df`` whose ``on`` is in the stored table ``ids``, nulls included."""
    few = ids.count() <= SMALL_IDS
    other = ids.select(F.col(on).alias("_id")).distinct()
    return df.join(F.broadcast(other) if few else other, F.col(on).eqNullSafe(F.col("_id")), "left_semi")


def _relabel(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Labels of the nodes after new links between them (stored, ``a, b``)."""
    if labels is None:
        return materialize(connected_components(links), "labels")
    rows = links.count()
    for end in ("a", "b"):
        named = links.groupBy(end).agg(F.count(F.lit(1)).alias("n")).join(labels.withColumnRenamed("node", end), end, "left")
        links = join_totals(links, named, end, "n", rows).withColumn(end, F.coalesce("component", end)).select("a", "b")
    merged = connected_components(links)
    moved = merged.select(F.col("node").alias("component"), F.col("component").alias("_new"))
    sizes = labels.groupBy("component").agg(F.count(F.lit(1)).alias("n")).join(moved, "component", "left")
    old = join_totals(labels, sizes, "component", "n", labels.count()).select("node", F.coalesce("_new", "component").alias("component"))
    fresh = merged.join(labels, "node", "left_anti")
    return materialize(old.unionByName(fresh), "labels")


def near_duplicates(docs: DataFrame, threshold: int = 80, size: int = SHINGLE, row: str | None = None) -> DataFrame:
    """Components of documents linked by ``100 * intersection >= threshold * union``.

    Texts are compared by the sets of their runs of ``size`` words, ASCII letters in
    lower case. Returns ``row, doc_id, n_shingles, component_id, kept, first`` for each
    row of ``docs``: ``component_id`` is the least id of its component, ``kept`` says
    that this is its own id, and ``first`` is true for one row of each component, the
    one with the least id and then the least ``row``. ``row`` names a column of unique
    long numbers; without it rows are numbered here. Null texts and texts without a
    word are alone; a null id comes last and is its own component id where there is
    no other; rows that repeat an id are rows of their own. ``threshold`` below 80
    would need other chunk sizes.
    """
    if threshold < 80:
        raise ValueError("the signature is laid out for thresholds of 80 and more")
    texts = docs.select("doc_id", "text", *([F.col(row).alias("row")] if row else []))
    kept = schema_with(docs, ["doc_id"], ("row bigint, " if row else "") + "n bigint, digest binary, sig binary")
    signed = texts.mapInArrow(releasing(_sign(size, bool(row))), kept)
    if not row:
        signed = signed.withColumn("row", F.monotonically_increasing_id())
    signed = materialize(signed, "signatures")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")
    nodes = signed.where("n > 0").groupBy("digest", "n").agg(F.min(F.struct(order.alias("o"), "sig")).alias("x"), F.count(F.lit(1)).alias("copies"))
    nodes = nodes.select(F.col("x.o.row").alias("node"), F.col("x.o.doc_id").alias("doc_id"), "digest", "n", "copies", F.col("x.sig").alias("sig"))
    nodes = materialize(nodes, "nodes")

    # the rows of a task are grouped in memory before they are shuffled
    dealt = nodes.select("node", "sig").repartition(max(partitions(nodes), -(-nodes.count() // FILED_NODES)))
    files = dealt.mapInArrow(_file, "key bigint, node bigint")
    shared = files.groupBy("key").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("members")).where("members > 1")
    shared = materialize(shared, "shared")
    large_files = cut_lineage(largest_keys(shared, ["key"], "members"))
    members = materialize(lookup_join(files, shared, ["key"], ["node"], hot=large_files), "files")

    filed = materialize(nodes.join(members.select("node").distinct(), "node", "left_semi"), "filed")
    sets = _near(docs.select("doc_id", "text"), filed, "doc_id").select("text").mapInArrow(releasing(_sets(size)), "digest binary, values binary")
    # several documents may have one set; one copy of it is enough
    sets = sets.join(filed.select("digest", "node", "n"), "digest").groupBy("node", "n").agg(F.first("values").alias("values"))
    sets = materialize(sets, "sets")
    summary = filed.select("node", "n", "sig")

    def confirmed(pairs: DataFrame) -> DataFrame:
        """The links among distinct candidate pairs ``a, b``; many may have one ``b``."""
        pairs = materialize(pairs, "pairs")
        hubs = cut_lineage(hot_keys(pairs, ["b"]))

        def both_ends(rows: DataFrame, table: DataFrame, names: list[str]) -> DataFrame:
            ends = [table.select(F.col("node").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in names]) for end in ("a", "b")]
            return lookup_join(rows.join(ends[0], "a"), ends[1], ["b"], ["a"], hot=hubs)

        sizes = 100 * F.least("n_a", "n_b") >= threshold * F.greatest("n_a", "n_b")
        close = both_ends(pairs, summary, ["n", "sig"]).where(sizes).where(_distance("sig_a", "sig_b") <= MAX_DISTANCE)
        both = both_ends(close.select("a", "b", "n_a", "n_b"), sets.select("node", "values"), ["values"])
        both = both.select("a", "b", "n_a", "n_b", _common("values_a", "values_b").alias("c"))
        return materialize(both.where(100 * F.col("c") >= threshold * (F.col("n_a") + F.col("n_b") - F.col("c"))).select("a", "b"), "links")

    def opened(labels: DataFrame, larger: int) -> DataFrame:
        """Rows of the files with more than ``larger`` members that hold several components."""
        marked = members.where(F.col("members") > larger).join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
        keys = marked.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y").select("key")
        return materialize(lookup_join(marked, keys, ["key"], ["node"], hot=large_files), "open")

    def in_blocks(rows: DataFrame, blocks: DataFrame, out: str) -> DataFrame:
        """``component, block, out``: the sets of ``rows`` (``node, component``) in blocks of about ``BLOCK_BYTES``.

        ``blocks`` has their number for each component, and further columns that are kept.
        """
        placed = join_totals(rows, blocks, "component", "rows", rows.count()).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
        more = [c for c in blocks.columns if c not in ("component", "rows", "blocks")]
        return placed.join(sets.select("node", "values"), "node").groupBy("component", "block", *more).agg(F.collect_list(F.struct("node", "values")).alias(out))

    def block_numbers(rows: DataFrame) -> DataFrame:
        """``component, rows, blocks``, from ``rows`` with the size ``n`` of their sets."""
        return rows.groupBy("component").agg(F.count(F.lit(1)).alias("rows"), F.ceil(F.sum("n") * 8 / BLOCK_BYTES).alias("blocks"))

    def asking_nodes(nodes: DataFrame) -> DataFrame:
        """``node, other``: nodes that may be linked to a larger component than their own.

        Shingles are ordered by how many nodes have them, those of a single component
        first. Of two linked sets the first ``n - ceil(threshold * n) + 1`` share one;
        what comes before it in either set is not common to both.
        """
        spread = sets.join(nodes, "node").select("node", "component", "values").mapInArrow(_spread, "shingle bigint, node bigint, component bigint, n bigint")
        shared = spread.groupBy("shingle").agg(F.count(F.lit(1)).alias("df"), F.min("component").alias("x"), F.max("component").alias("y"))
        common = spread.join(shared.where("x < y").select("shingle", "df"), "shingle")
        # a list is a part of one document
        lists = common.groupBy("node", "component", "n").agg(F.array_sort(F.collect_list(F.struct("df", "shingle"))).alias("list"))
        places = lists.select("node", "component", "n", F.posexplode("list").alias("k", "s"), (F.col("n") - F.size("list")).alias("own"))
        place = (F.col("own") + F.col("k") + 1).alias("place")
        first = places.select("node", "component", "n", F.col("s.shingle").alias("shingle"), place).where(
            F.col("place") <= F.col("n") - F.ceil(F.col("n") * threshold / 100) + 1
        )
        sizes = nodes.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
        first = first.join(join_totals(nodes, sizes, "component", "size", nodes.count()).select("node", "size"), "node")
        others = first.groupBy("shingle", "component", "size", "n").agg(F.min("place").alias("place"))
        others = others.select("shingle", *[F.col(c).alias(f"_{c}") for c in ("component", "size", "n", "place")])
        most = 1 + F.least(F.col("n") - F.col("place"), F.col("_n") - F.col("_place"))
        linked = (most * (100 + threshold) >= threshold * (F.col("n") + F.col("_n"))) & (100 * F.least("n", "_n") >= threshold * F.greatest("n", "_n"))
        smaller = F.struct("size", "component") < F.struct("_size", "_component")
        met = first.join(others, (first["shingle"] == others["shingle"]) & smaller & linked)
        return met.select("node", F.col("_component").alias("other")).distinct()

    def compared(rows: DataFrame, labels: DataFrame) -> DataFrame:
        """Links between the nodes of files with several components.

        A block of asking nodes goes to each block of the component it asks; the two
        meet by component and block, so a large component is spread over all tasks.
        """
        own = materialize(rows.select("node", "component").distinct(), "open-nodes")
        asks = materialize(asking_nodes(own), "asks").withColumnRenamed("other", "component").join(summary.select("node", "n"), "node")
        asks = materialize(asks, "asks")
        everyone = summary.select("node", "n").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
        everyone = materialize(everyone, "everyone")
        to = block_numbers(everyone).join(asks.select("component").distinct(), "component")
        asked = in_blocks(everyone.select("node", "component"), to, "asked")
        of = block_numbers(asks).join(to.select("component", F.col("blocks").alias("targets")), "component")
        asking = in_blocks(asks.select("node", "component"), of, "asking").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("targets") - 1)))
        asking = asking.select("component", F.col("block").cast("bigint").alias("block"), "asking")
        pairs = asking.join(asked, ["component", "block"])
        return materialize(pairs.select("asking", "asked").mapInArrow(_compare(threshold), "a bigint, b bigint"), "links")

    # one pair for each member: the least hub it has
    first = members.groupBy("node").agg(F.min("hub").alias("b")).where("node <> b").select(F.col("node").alias("a"), "b")
    labels = _relabel(None, confirmed(first))
    # every member with the hub of each file
    marked = opened(labels, 1)
    hubs = marked.where("node = hub").select("key", F.col("component").alias("other"))
    pairs = lookup_join(marked, hubs, ["key"], ["node"], hot=large_files).where("component <> other").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    labels = _relabel(labels, confirmed(pairs))
    # what is left with all other components of its files
    marked = opened(labels, 2)
    if not marked.isEmpty():
        labels = _relabel(labels, compared(marked, labels))

    whole = nodes.join(labels, "node", "left").select("digest", "node", "doc_id", F.coalesce("component", "node").alias("component"))
    whole = materialize(whole, "whole")
    lead = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", F.col("node").alias("row")))
    heads = whole.groupBy("component").agg(lead.alias("head"), F.count(F.lit(1)).alias("nodes"))
    named = join_totals(whole, heads, "component", "nodes", whole.count()).select("digest", F.col("head.doc_id").alias("component_id"), F.col("head.row").alias("_first"))
    copied = largest_keys(nodes, ["digest"], "copies")
    out = lookup_join(signed.select("row", "doc_id", "n", "digest"), named, ["digest"], ["row"], "left", hot=copied)
    alone = F.col("n") == 0
    component = F.when(alone, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select(
        "row",
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
        (alone | (F.col("row") == F.col("_first"))).alias("first"),
    )


def drop_near_duplicates(docs: DataFrame, threshold: int = 80, size: int = SHINGLE) -> DataFrame:
    """``docs`` with one row of each component of near-duplicates; see :func:`near_duplicates`."""
    numbered = materialize(docs.withColumn("_near_dup_row", F.monotonically_increasing_id()), "numbered")
    found = near_duplicates(numbered, threshold, size, row="_near_dup_row")
    gone = materialize(found.where("not first").select(F.col("row").alias("_near_dup_row")), "dropped")
    few = gone.count() <= SMALL_IDS
    return numbered.join(F.broadcast(gone) if few else gone, "_near_dup_row", "left_anti").select(*[f"`{c}`" for c in docs.columns])
