"""Ids of texts from the ids of their words, each word of a batch taken once."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Distinct words whose ids a task remembers.
REMEMBERED = 200_000

Coder = Callable[[list[str]], list[list[int]]]


def ids_column(make: Callable[[], Coder]) -> Callable[[Column], Column]:
    """Column function from word lists to id lists.

    ``make`` builds a coder, once per task, from distinct words to their ids. Nothing is
    shuffled: the distinct words of a batch are coded together and put back in place,
    and what a task has coded it remembers. Null lists have no ids.
    """

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def to_ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        code, known = make(), {}
        for lists in batches:
            coded = lists.flatten().dictionary_encode()
            words = coded.dictionary.to_pylist()
            new = [w for w in words if w not in known]
            if len(known) + len(new) > REMEMBERED:
                known, new = {}, words
            known.update(zip(new, code(new)))
            by_word = pa.array([known[w] for w in words], pa.list_(pa.int32())).take(coded.indices)
            # a row's ids are those of its words, one after the other
            sizes = [0, *lists.value_lengths().fill_null(0).to_pylist()]
            ends = pa.array(sizes, pa.int64()).to_numpy().cumsum()
            yield pa.ListArray.from_arrays(by_word.offsets.take(pa.array(ends)), by_word.values)

    return to_ids
