"""Byte-pair encoding and decoding with a minimal acyclic transducer as lexicon.

The words of the corpus are counted, and the frequent ones are merged once and compiled
into an automaton that shares endings as well as beginnings. Its edges carry numbers
whose sum along a path is the word's place in the table of ids. The automaton is one
file that Spark hands to every executor and all of its Python processes map into
memory. Words that it does not hold are merged where they are met, exactly.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import math
import os
import tempfile
import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkstrata.llm.common import hold, schema_with, slices, texts_of
from inkstrata.llm.pieces import Pieces, byte_characters
from inkstrata.session import materialize

# Words of the lexicon at most, and bytes of one of them.
WORDS = 65_536
WORD_BYTES = 64
# Distinct words a task counts before it hands them on.
COUNTED = 200_000
# Symbols of a piece that is merged by looking through it.
SHORT = 64
# Widths of the tables in which pieces are merged side by side, and their rows.
WIDTHS = (8, 12, 16, 24, 32)
SIDE_BY_SIDE = 16_384
# Buckets of word counts for each doubling.
STEPS = 16
# Unseen words remembered by one Python worker.
REMEMBERED = 200_000


class Merges:
    """Merges of a tokenizer file, applied to one piece: least rank first, then leftmost."""

    def __init__(self, file: dict):
        model = file["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        shown = byte_characters()
        self.inner = [vocab.get(c) for c in shown]
        self.final = [vocab.get(c + suffix) for c in shown]
        self.rank: dict[int, int] = {}
        self.made: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.rank[vocab[left] << 32 | vocab[right]] = rank
            self.made.append(vocab[left + right])
        self._keys = np.array(sorted(self.rank), np.int64)
        self._ranks = np.array([self.rank[k] for k in self._keys.tolist()], np.int64)
        self._whole = None not in self.inner and None not in self.final and bool(self.rank)

    def all_ids(self, pieces: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of many pieces; those of like length are merged side by side."""
        out: list[bytes] = [b""] * len(pieces)
        rows: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            width = next((w for w in WIDTHS if len(piece) <= w), 0) if self._whole else 0
            if width:
                rows.setdefault(width, []).append(i)
            else:
                out[i] = np.array(self.ids(piece), "<u4").tobytes()
        for width, own in rows.items():
            for at in range(0, len(own), SIDE_BY_SIDE):
                block = own[at : at + SIDE_BY_SIDE]
                for i, ids in zip(block, self._side_by_side([pieces[i] for i in block], width)):
                    out[i] = ids
        return out

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        place = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return np.where((self._keys[place] == key) & (right >= 0), self._ranks[place], len(self.made))

    def _side_by_side(self, pieces: list[bytes], width: int) -> Iterator[bytes]:
        """One merge in every row and round: the least rank's, the first of equal ones."""
        count, none = len(pieces), len(self.made)
        made, columns = np.array(self.made, np.int64), np.arange(width)
        size = np.fromiter(map(len, pieces), np.int64, count)
        data = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), "u1").reshape(count, width)
        ids = np.where(columns < size[:, None], np.array(self.inner, np.int64)[data], -1)
        every = np.arange(count)
        ids[every, size - 1] = np.array(self.final, np.int64)[data[every, size - 1]]
        ranks = np.full((count, width), none)
        ranks[:, :-1] = self._look_up(ids[:, :-1], ids[:, 1:])
        done = np.empty((count, width), "<u4")
        while len(every):
            at = ranks.argmin(1)
            least = ranks[np.arange(len(every)), at]
            ended = least == none
            if ended.any():
                done[every[ended]] = ids[ended]
                size[every[ended]] = (ids[ended] >= 0).sum(1)
                every, ids, ranks, at, least = every[~ended], ids[~ended], ranks[~ended], at[~ended], least[~ended]
            row = np.arange(len(every))
            ids[row, at] = made[least]
            # close the gap right of the new id
            after = columns + (columns > at[:, None])
            ids = np.take_along_axis(np.pad(ids, ((0, 0), (0, 1)), constant_values=-1), after, 1)
            after = columns + (columns >= at[:, None])
            ranks = np.take_along_axis(np.pad(ranks, ((0, 0), (0, 1)), constant_values=none), after, 1)
            more = at + 1 < width
            ranks[row[more], at[more]] = self._look_up(ids[row[more], at[more]], ids[row[more], at[more] + 1])
            ranks[row[~more], at[~more]] = none
            near = at > 0
            ranks[row[near], at[near] - 1] = self._look_up(ids[row[near], at[near] - 1], ids[row[near], at[near]])
        for line, length in zip(done, size.tolist()):
            yield line[:length].tobytes()

    def ids(self, piece: bytes) -> list[int]:
        """Ids of ``piece``; bytes that have no id of their own are left out, as the file says nothing of them."""
        ids = self._start(piece)
        return self._short(ids) if len(ids) <= SHORT else self._long(ids)

    def _start(self, piece: bytes) -> list[int]:
        ids = [self.inner[b] for b in piece[:-1]] + [self.final[piece[-1]]]
        return [i for i in ids if i is not None] if None in ids else ids

    def _short(self, ids: list[int]) -> list[int]:
        get, none, made = self.rank.get, len(self.made), self.made
        ranks = [get(a << 32 | b, none) for a, b in zip(ids, ids[1:])]
        while ranks and (least := min(ranks)) < none:
            at = ranks.index(least)
            ids[at : at + 2] = [made[least]]
            del ranks[at]
            if at < len(ranks):
                ranks[at] = get(ids[at] << 32 | ids[at + 1], none)
            if at:
                ranks[at - 1] = get(ids[at - 1] << 32 | ids[at], none)
        return ids

    def _long(self, ids: list[int]) -> list[int]:
        """The same by a heap, for pieces of any length."""
        count, get, made = len(ids), self.rank.get, self.made
        after, before = list(range(1, count + 1)), list(range(-1, count - 1))
        waiting: list[tuple[int, int]] = []

        def wait(at: int, right: int) -> None:
            rank = get(ids[at] << 32 | ids[right])
            if rank is not None:
                heapq.heappush(waiting, (rank, at))

        for at in range(count - 1):
            wait(at, at + 1)
        while waiting:
            rank, at = heapq.heappop(waiting)
            right = after[at]
            # what stood here may have been merged since
            if ids[at] < 0 or right >= count or get(ids[at] << 32 | ids[right]) != rank:
                continue
            ids[at], ids[right] = made[rank], -1
            after[at] = far = after[right]
            if far < count:
                before[far] = at
                wait(at, far)
            if before[at] >= 0:
                wait(before[at], at)
        return [i for i in ids if i >= 0]


def compile_lexicon(words: list[tuple[bytes, bytes]]) -> bytes:
    """File of the minimal transducer of ``words`` (distinct, not empty, with their little-endian 32-bit ids).

    States with the same endings are one state: a state is written when no more words
    can pass through it, unless an equal one has been. Edges are sorted by state and
    byte. An edge's number is how many words go before all that lie behind it.
    """
    words = sorted(words)
    known: dict[tuple, int] = {}
    finals, edges_of, behind = [], [], []
    # the path of the last word: edges that are settled, and whether a word ends there
    path: list[tuple[list[tuple[int, int]], bool]] = [([], False)]

    def settle(edges: list[tuple[int, int]], final: bool) -> int:
        key = (final, *edges)
        if key not in known:
            known[key] = len(finals)
            finals.append(final)
            edges_of.append(edges)
            behind.append(final + sum(behind[target] for _, target in edges))
        return known[key]

    last = b""

    def shorten(to: int) -> None:
        while len(path) - 1 > to:
            edges, final = path.pop()
            path[-1][0].append((last[len(path) - 1], settle(edges, final)))

    for word, _ in words:
        shared = len(os.path.commonprefix([word, last]))
        shorten(shared)
        path += [([], False) for _ in word[shared:]]
        path[-1] = (path[-1][0], True)
        last = word
    shorten(0)
    start = settle(*path[0])

    keys, targets, numbers = [], [], []
    for state, edges in enumerate(edges_of):
        before = int(finals[state])
        for byte, target in edges:
            keys.append(state << 8 | byte)
            targets.append(target)
            numbers.append(before)
            before += behind[target]
    ids = [own for _, own in words]
    arrays = {
        "keys": np.array(keys, "<i8"),
        "targets": np.array(targets, "<i4"),
        "numbers": np.array(numbers, "<i4"),
        "finals": np.array(finals, "u1"),
        "ends": np.cumsum([0, *(len(own) // 4 for own in ids)]).astype("<i8"),
        "ids": np.frombuffer(b"".join(ids), "<u4"),
    }
    head, at = {}, 0
    for name, array in arrays.items():
        head[name] = (array.dtype.str, at, len(array))
        at += -(-array.nbytes // 8) * 8
    text = json.dumps({"start": start, "longest": max((len(w) for w, _ in words), default=0), "arrays": head}).encode()
    text = text.ljust(-(-len(text) // 8) * 8)
    body = b"".join(array.tobytes().ljust(-(-array.nbytes // 8) * 8, b"\0") for array in arrays.values())
    return len(text).to_bytes(8, "little") + text + body


class Lexicon:
    """A compiled file, mapped into memory; looks up many words at a time."""

    def __init__(self, path: str):
        data = np.asarray(np.memmap(path, dtype="u1", mode="r"))
        size = int.from_bytes(data[:8].tobytes(), "little")
        head = json.loads(data[8 : 8 + size].tobytes())
        self.start, self.longest = head["start"], head["longest"]
        for name, (kind, at, length) in head["arrays"].items():
            first = 8 + size + at
            setattr(self, name, data[first : first + length * np.dtype(kind).itemsize].view(kind))
        self.table = memoryview(self.ids).cast("B") if len(self.ids) else memoryview(b"")

    def places(self, words: list[bytes]) -> np.ndarray:
        """The place of each word in the table of ids, -1 for words that are not held."""
        number = np.zeros(len(words), np.int64)
        if not len(self.keys):
            return number - 1
        size = np.fromiter(map(len, words), np.int64, len(words))
        first = np.cumsum(size) - size
        data = np.frombuffer(b"".join(words), "u1")
        state = np.full(len(words), self.start, np.int64)
        alive = np.flatnonzero((size > 0) & (size <= self.longest))
        held = np.zeros(len(words), bool)
        step = 0
        while len(alive):
            key = state[alive] << 8 | data[first[alive] + step]
            edge = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            found = self.keys[edge] == key
            alive, edge = alive[found], edge[found]
            state[alive] = self.targets[edge]
            number[alive] += self.numbers[edge]
            step += 1
            ended = size[alive] == step
            held[alive[ended]] = self.finals[state[alive[ended]]] > 0
            alive = alive[~ended]
        return np.where(held, number, -1)

    def ids_of(self, places: np.ndarray) -> list[bytes]:
        """Little-endian 32-bit ids of the words at ``places``."""
        table = self.table
        return [bytes(table[a:b]) for a, b in zip((4 * self.ends[places]).tolist(), (4 * self.ends[places + 1]).tolist())]


class Encoder:
    """Texts to ids: pieces from the lexicon, others merged and remembered for a while."""

    def __init__(self, tokenizer: str, lexicon: str | None):
        self.pieces = Pieces(tokenizer)
        self.merges = Merges(self.pieces.file)
        self.lexicon = Lexicon(lexicon) if lexicon else None
        self.unseen: dict[str, bytes] = {}

    def learn(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of distinct pieces."""
        out, unseen = {}, pieces
        if self.lexicon:
            places = self.lexicon.places([p.encode("utf-8") for p in pieces])
            held = np.flatnonzero(places >= 0)
            out.update(zip([pieces[i] for i in held.tolist()], self.lexicon.ids_of(places[held])))
            unseen = [pieces[i] for i in np.flatnonzero(places < 0).tolist()]
        if len(self.unseen) > REMEMBERED:
            self.unseen.clear()
        new = [piece for piece in unseen if piece not in self.unseen]
        self.unseen.update(zip(new, self.merges.all_ids([piece.encode("utf-8") for piece in new])))
        out.update((piece, self.unseen[piece]) for piece in unseen)
        return out

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Little-endian 32-bit ids of each text."""
        cut = [self.pieces.cut(text) for text in texts]
        known: dict[str | int, bytes] = {i: np.array([i], "<u4").tobytes() for i in self.pieces.special.values()}
        wanted: set[str | int] = set()
        for pieces in cut:
            wanted.update(pieces)
        known.update(self.learn(list(wanted.difference(known))))
        get = known.__getitem__
        for pieces in cut:
            yield b"".join(map(get, pieces))


class Decoder:
    """Ids to texts, as a file without a decoder has it: tokens parted by blanks, unknown ids left out."""

    def __init__(self, file: dict):
        if file.get("decoder") is not None:
            raise ValueError("a tokenizer file with a decoder is not covered")
        self.token: dict[int, str] = {i: token for token, i in file["model"]["vocab"].items()}
        self.token.update((t["id"], t["content"]) for t in file["added_tokens"])

    def decode(self, ids: list[int]) -> str:
        try:
            return " ".join(map(self.token.__getitem__, ids))
        except KeyError:
            return " ".join(self.token[i] for i in ids if i in self.token)


def _file(name: str) -> str:
    """A tokenizer's file: a path, or the name of a public one, found where the code runs."""
    if Path(name).name != name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


# One per Python worker and lexicon; workers outlive tasks.
_encoders: dict[tuple[str, str | None], Encoder] = {}
_decoders: dict[str, Decoder] = {}


def _release() -> None:
    _encoders.clear()
    _decoders.clear()


def _encoder(tokenizer: str, lexicon: str | None) -> Encoder:
    hold("transducer", _release)
    if (tokenizer, lexicon) not in _encoders:
        _encoders.clear()
        _encoders[tokenizer, lexicon] = Encoder(_file(tokenizer), SparkFiles.get(lexicon) if lexicon else None)
    return _encoders[tokenizer, lexicon]


def _decoder(tokenizer: str) -> Decoder:
    hold("transducer", _release)
    if tokenizer not in _decoders:
        _decoders[tokenizer] = Decoder(json.loads(Path(_file(tokenizer)).read_text(encoding="utf-8")))
    return _decoders[tokenizer]


def word_counts(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``word, n`` of all pieces of all texts; counted in the tasks before they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, seen = _encoder(tokenizer, None).pieces, Counter()

        def counted() -> pa.RecordBatch:
            words = [w for w in seen if isinstance(w, str)]
            made = pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([seen[w] for w in words], pa.int64())], names=["word", "n"])
            seen.clear()
            return made

        for batch in slices(batches):
            for text in texts_of(batch.column(0)):
                seen.update(pieces.cut(text))
                if len(seen) > COUNTED:
                    yield counted()
        yield counted()

    texts = docs.select(F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, words: int = WORDS) -> DataFrame:
    """The words of ``counts`` from a count on, as many as stay within ``words``.

    The count is found from a histogram of the counts, so no task sorts all words.
    """
    fit = counts.where(F.octet_length("word") <= WORD_BYTES).withColumn("bucket", F.floor(F.log2("n") * STEPS).cast("int"))
    sizes = sorted(fit.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True)
    least, held = None, 0
    for bucket, size in sizes:
        held += size
        if held > words:
            break
        least = bucket
    return fit.where(F.col("bucket") >= (math.inf if least is None else least)).select("word")


def lexicon(docs: DataFrame, tokenizer: str, words: int = WORDS) -> str:
    """Compile the frequent words of ``docs``; the name of the file that every executor gets.

    At most ``words`` words of at most ``WORD_BYTES`` bytes reach the driver. Which words
    are held does not change any result. The file stays with the session, as code does.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = _encoder(tokenizer, None).merges
        for batch in batches:
            made = merges.all_ids([word.encode("utf-8") for word in batch.column(0).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], names=["word", "ids"])

    spark = docs.sparkSession
    # counts are needed twice
    counts = materialize(word_counts(docs, tokenizer), "word-counts")
    held = frequent_words(counts, words).mapInArrow(run, "word string, ids binary").collect()
    name = f"lexicon-{uuid.uuid4().hex}"
    path = Path(tempfile.mkdtemp(prefix="inkstrata-")) / name
    path.write_bytes(compile_lexicon([(r["word"].encode("utf-8"), bytes(r["ids"])) for r in held]))
    spark.sparkContext.addFile(str(path))
    return name


def _encoded(tokenizer: str, name: str, text: int, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    encoder = _encoder(tokenizer, name)
    for batch in slices(batches):
        yield batch, list(encoder.encode(texts_of(batch.column(text))))


def encode(docs: DataFrame, tokenizer: str, out: str = "ids", words: int = WORDS) -> DataFrame:
    """``docs`` with the ids of ``text`` as ``out``, little-endian 32-bit numbers.

    Ids are those of the tokenizer file with nothing added; strings of special tokens
    in a text are these tokens. A null text is the empty text and has no ids. ``docs``
    is read twice. Where ``docs`` has a column ``out`` already, that is an error;
    other names do not clash.
    """
    if out in docs.columns:
        raise ValueError(f"there is a column {out!r} already")
    name = lexicon(docs, tokenizer, words)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, ids in _encoded(tokenizer, name, at, batches):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.binary())], names=[*batch.schema.names, out])

    return docs.mapInArrow(run, schema_with(docs, docs.columns, f"`{out}` binary"))


def _decode(tokenizer: str, ids: list[bytes | None]) -> Iterator[str]:
    decoder = _decoder(tokenizer)
    for data in ids:
        yield decoder.decode(np.frombuffer(data or b"", "<u4").tolist())


def decode(df: DataFrame, tokenizer: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the text of its ``ids`` as ``out``; null ids are no ids. Special tokens are kept."""
    if out in df.columns:
        raise ValueError(f"there is a column {out!r} already")
    at = df.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = list(_decode(tokenizer, batch.column(at).to_pylist()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, out])

    return df.mapInArrow(run, schema_with(df, df.columns, f"`{out}` string"))


def report(docs: DataFrame, tokenizer: str, words: int = WORDS) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: encoded and decoded in one pass."""
    narrow = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    name = lexicon(narrow, tokenizer, words)

    def digest(text: str) -> str:
        return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shown: dict[int, str] = {}
        for batch, made in _encoded(tokenizer, name, 1, batches):
            numbers, digests = [], []
            for ids in made:
                values = np.frombuffer(ids, "<u4")
                shown.update((i, str(i)) for i in np.unique(values).tolist() if i not in shown)
                numbers.append(len(values))
                digests.append(digest(" ".join(map(shown.__getitem__, values.tolist()))))
            decoded = [digest(text) for text in _decode(tokenizer, made)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(numbers, pa.int64()), pa.array(digests), pa.array(decoded)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            )

    schema = T.StructType([narrow.schema["doc_id"], *T.StructType.fromDDL("n_tokens bigint, ids_sha256 string, decoded_sha256 string")])
    return narrow.mapInArrow(run, schema)
