"""Packing of tokenised documents into fixed windows: concatenate and cut.

Two passes. The first tokenises each document once, ends it with an end id and
writes the ids together with the number of ids before it in its partition. The
second turns the partition totals, one row per partition, into prefix sums; so
every document knows its place in the concatenation of all documents, and is cut
where that place crosses a multiple of the window. A window that spans two
partitions is made of boundary records: each piece names its window and its
offset in it.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkstrata.llm.common import give_back, hold, releasing, schema_with, slices, texts_of
from inkstrata.llm.pieces import unsupported
from inkstrata.session import fresh_dir

WINDOW = 4096
END_ID = 2
# Memory for the pieces that one Python worker remembers, and what a piece takes besides its characters and ids.
CACHE_BYTES = 112 << 20
_ENTRY_BYTES = 200
# Rows whose pieces are held at once.
_ROWS = 128

# Texts of these characters only, without the opening of a special token, can be
# cut into pieces here: lower-casing and normal forms are plain for them.
_PLAIN_CHARACTERS = "[\t\n\r\\x20-;=-~¡-įı-ſ]"
_PLAIN = re.compile(rf"{_PLAIN_CHARACTERS}*+(?:<(?!\|){_PLAIN_CHARACTERS}*+)*+")
# The split pattern of the tokenizer, for lower-case plain texts.
_LETTER = "a-zªµºß-öø-ſ"
_NUMBER = "0-9²³¹¼-¾"
_PIECE = re.compile(f"[{_LETTER}]+|[{_NUMBER}]|'s|'t|'re|'ve|'m|'ll|'d|[^\\s{_LETTER}{_NUMBER}]+")
_JOINED = 1000


class CachedTokenizer:
    """A tokenizer file whose pieces are looked up before they are encoded.

    Pieces never see each other's neighbours in this kind of model (words end in
    ``</w>`` and white space is dropped), so the ids of a text are the ids of its
    pieces one after the other. Distinct new pieces are encoded in one call, parted
    by spaces; the ends of words in the ids tell them apart. Texts with characters
    whose case or normal form depends on more than themselves are encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        # other kinds of files encode every text whole
        self.cuts = unsupported(json.loads(Path(path).read_text(encoding="utf-8"))) is None
        self.ends = np.zeros(self.model.get_vocab_size() + 1, dtype=bool)
        for piece, number in self.model.get_vocab().items():
            self.ends[number] = piece.endswith("</w>")
        self.known: dict[str, bytes] = {}
        self.known_bytes = 0

    def _whole(self, text: str) -> bytes:
        return np.asarray(self.model.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _learn(self, pieces: list[str]) -> None:
        for at in range(0, len(pieces), _JOINED):
            block = pieces[at : at + _JOINED]
            self.known_bytes += len(block) * _ENTRY_BYTES + sum(map(len, block))
            ids = np.asarray(self.model.encode(" ".join(block), add_special_tokens=False).ids, dtype="<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(block):
                self.known.update((piece, self._whole(piece)) for piece in block)
                self.known_bytes += sum(len(self.known[piece]) for piece in block)
                continue
            data, start = ids.tobytes(), 0
            self.known_bytes += len(data)
            for piece, end in zip(block, (cuts * 4).tolist()):
                self.known[piece] = data[start:end]
                start = end

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        cut = [_PIECE.findall(text.lower()) if self.cuts and _PLAIN.fullmatch(text) else None for text in texts]
        if self.known_bytes > CACHE_BYTES:
            self.known.clear()
            self.known_bytes = 0
        new: set[str] = set()
        for pieces in cut:
            new.update(pieces or ())
        self._learn(list(new.difference(self.known)))
        get = self.known.__getitem__
        return [self._whole(text) if pieces is None else b"".join(map(get, pieces)) for text, pieces in zip(texts, cut)]


# One per Python worker; workers outlive tasks, and so do the pieces they know.
_loaded: dict[str, CachedTokenizer] = {}


def _tokenizer(path: str) -> CachedTokenizer:
    if path not in _loaded:
        _loaded[path] = CachedTokenizer(path)
        # a file takes several times its model's memory to read
        give_back()
    return _loaded[path]


def _encode(path: str, end_id: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("packing", _loaded.clear)
        tokenizer = _tokenizer(path)
        part, before = TaskContext.get().partitionId(), 0
        for batch in slices(batches, _ROWS):
            encoded = [ids + end for ids in tokenizer.encode(texts_of(batch.column(1)))]
            sizes = np.fromiter((len(ids) // 4 for ids in encoded), dtype=np.int64, count=len(encoded))
            starts = before + np.cumsum(sizes) - sizes
            before += int(sizes.sum())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([part] * len(encoded), pa.int32()),
                    pa.array(starts),
                    pa.array(sizes),
                    pa.array(encoded, pa.binary()),
                ],
                names=[batch.schema.names[0], "part", "before", "n_tokens", "ids"],
            )

    return run


def tokenize(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """First pass, written to the shared folder: ``doc_id, part, before, n_tokens, ids``.

    ``ids`` are little-endian 32-bit ids with ``end_id`` as the last; ``before``
    counts the ids of earlier rows of the same partition. A null text is the empty
    text, a null or repeated ``doc_id`` is kept as it is.
    """
    spark = docs.sparkSession
    schema = schema_with(docs, ["doc_id"], "part int, before bigint, n_tokens bigint, ids binary")
    path = fresh_dir(spark, "tokens")
    encoded = docs.select("doc_id", "text").mapInArrow(releasing(_encode(tokenizer, end_id)), schema)
    encoded.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def _cut(window: int, with_ids: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def pieces_of(row: int, first: int, ids: memoryview) -> Iterator[tuple]:
        size, start = len(ids) // 4, 0
        while start < size:
            sequence, offset = divmod(first + start, window)
            length = min(window - offset, size - start)
            part = ids[4 * start : 4 * (start + length)]
            yield row, start, length, zlib.crc32(part), size, sequence, offset, bytes(part) if with_ids else None
            start += length

    names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
    kinds = [pa.int64()] * 6 + [pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the first pass is over: its tokenizer and pieces go
        hold("packing_cut")
        for batch in slices(batches):
            firsts, totals = batch.column(1).to_pylist(), batch.column(2)
            made = [piece for row, first in enumerate(firsts) for piece in pieces_of(row, first, memoryview(batch.column(3)[row].as_buffer()))]
            columns = list(zip(*made))
            rows = pa.array(columns[0], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), totals.take(rows)]
                + [pa.array(values, kind) for values, kind in zip(columns[1:], kinds)],
                names=[batch.schema.names[0], "total", *names],
            )

    return run


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """One row per piece of a document in a window of ``window`` ids.

    ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_length``
    and the piece's ``ids`` (little-endian 32 bits) if asked for. Every window but
    the last is full; ``sequence_length`` is the padded length: ``window``, or for
    the last one the smallest power of two that holds it. No documents give no rows.
    """
    tokens = tokenize(docs, tokenizer, end_id)
    # one row per partition of the first pass
    totals = tokens.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    whole = Window.orderBy("part")
    bases = totals.select(
        "part",
        (F.sum("n").over(whole) - F.col("n")).alias("base"),
        F.sum("n").over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("total"),
    )
    placed = tokens.join(F.broadcast(bases), "part").select("doc_id", (F.col("base") + F.col("before")).alias("first"), "total", "ids")
    schema = schema_with(
        docs,
        ["doc_id"],
        "total bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary",
    )
    cut = placed.mapInArrow(_cut(window, with_ids), schema)
    last = F.floor((F.col("total") - 1) / window)
    rest = F.col("total") - last * window
    power = F.lit(1).cast("bigint")
    size = 1
    while size < window:
        power = F.when(rest > size, F.lit(min(2 * size, window))).otherwise(power)
        size *= 2
    padded = cut.withColumn("sequence_length", F.when(F.col("sequence_id") < last, F.lit(window)).otherwise(power).cast("bigint"))
    return padded.drop("total") if with_ids else padded.drop("total", "ids")


def sequences(pieces: DataFrame) -> DataFrame:
    """Whole windows from pieces with ids: ``sequence_id, sequence_length, ids, records``.

    ``records`` are the boundary records ``(offset, length, doc_id, start)`` in
    order; a group is one window, so its size is bounded.
    """
    record = F.struct("offset", "length", "doc_id", "start", "ids")
    rows = pieces.groupBy("sequence_id", "sequence_length").agg(F.array_sort(F.collect_list(record)).alias("rows"))
    joined = F.aggregate("rows.ids", F.lit(b""), lambda a, x: F.concat(a, x))
    records = F.transform("rows", lambda r: F.struct(r["offset"].alias("offset"), r["length"].alias("length"), r["doc_id"].alias("doc_id"), r["start"].alias("start")))
    return rows.select("sequence_id", "sequence_length", joined.alias("ids"), records.alias("records"))
