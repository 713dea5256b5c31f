"""Secret scans with a trigram inverted index.

Each rule is turned into a Boolean query over trigrams. The index is partitioned
by documents: for a block of documents a task makes the postings of the trigrams
that the rules ask for, intersects and merges them into the candidates of each
rule, and verifies only these with the rule itself. A rule without a mandatory
trigram is tried on the whole block. Nothing is shuffled, and whole texts are used.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkstrata.llm import spans as sp
from inkstrata.llm.common import slices, texts_of
from inkstrata.llm.trigrams import Query, query_of

REDACTED = "[SECRET]"


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` with at least ``least`` characters in ``group``."""

    kind: str
    pattern: str
    least: int
    group: int = 0
    base: bool = False
    # a form for one pass over every text that finds the kept matches and no others
    scan: str = ""


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token")) + f"|{_either_case('api')}_?{_either_case('key')}"

# The kinds that every report counts, in this order, then the added ones.
RULES = (
    Rule("assign", rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2, True),
    Rule("access", r"AKIA[A-Z0-9]+", 18, 0, True),
    Rule("hex", r"[0-9a-f]+", 16, 0, True, r"[0-9a-f]{16,}"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 24),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 39),
    Rule("stripe", r"[sr]k_live_[A-Za-z0-9]+", 24),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 40),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 27),
)
BASE = [rule.kind for rule in RULES if rule.base]


@functools.cache
def _compiled() -> tuple[list[tuple[Rule, re.Pattern, Query]], np.ndarray, list[str]]:
    """Rules with their expressions and queries, and the numbers of the asked trigrams."""
    made = []
    for rule in RULES:
        query = query_of(rule.pattern)
        pattern = rule.scan if query.op == "any" and rule.scan else rule.pattern
        made.append((rule, re.compile(pattern), query))
    asked = sorted(set().union(*(query.trigrams() for _, _, query in made)))
    codes = np.zeros(1 << 24, dtype=np.uint16)
    for number, trigram in enumerate(asked, 1):
        a, b, c = trigram.encode()
        codes[a << 16 | b << 8 | c] = number
    return made, codes, asked


_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def postings(data: list[bytes]) -> dict[str, set[int]]:
    """Rows that hold each of the asked trigrams, in lower case, for a block of texts."""
    _, codes, asked = _compiled()
    out: dict[str, set[int]] = {trigram: set() for trigram in asked}
    # three bytes that no trigram has part the texts
    joined = np.frombuffer(b"\xff\xff\xff".join(data).translate(_LOWER), dtype=np.uint8).astype(np.uint32)
    if len(joined) < 3:
        return out
    numbers = codes[joined[:-2] << 16 | joined[1:-1] << 8 | joined[2:]]
    at = np.flatnonzero(numbers)
    ends = np.cumsum(np.fromiter((len(d) + 3 for d in data), dtype=np.int64, count=len(data)))
    rows = np.searchsorted(ends, at, "right")
    for pair in np.unique(rows << 16 | numbers[at]).tolist():
        out[asked[(pair & 0xFFFF) - 1]].add(pair >> 16)
    return out


Span = tuple[int, int, int]


def scan_block(texts: list[str]) -> list[list[Span]]:
    """Spans ``(start, rank, end)`` of every text, sorted; offsets are code points."""
    found: list[list[Span]] = [[] for _ in texts]
    held = postings([text.encode("utf-8", "surrogatepass") for text in texts])
    for rank, (rule, pattern, query) in enumerate(_compiled()[0]):
        candidates = query.rows(held.__getitem__)
        for row in range(len(texts)) if candidates is None else candidates:
            for match in pattern.finditer(texts[row]):
                start, end = match.span(rule.group)
                if end - start >= rule.least:
                    found[row].append((match.start(), rank, match.end()))
    for spans in found:
        spans.sort()
    return found


_SPANS = T.ArrayType(
    T.StructType([T.StructField("start", T.IntegerType()), T.StructField("rank", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("kind", T.StringType())])
)
_ARROW_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("rank", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))


def _find(text: str, out: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = scan_block(texts_of(batch.column(batch.schema.get_field_index(text))))
            rows = [[{"start": s, "rank": r, "end": e, "kind": RULES[r].kind} for s, r, e in spans] for spans in found]
            yield batch.append_column(out, pa.array(rows, _ARROW_SPANS))

    return run


def find_secrets(docs: DataFrame, text: str = "text", out: str = "secrets") -> DataFrame:
    """``docs`` with the column ``out`` of spans: ``array<struct<start, rank, end, kind>>``.

    Sorted by start, then by the place of the kind in ``RULES``; offsets are code
    points, ends exclusive. A null or empty text has no spans; a column of the name
    ``out`` is replaced.
    """
    kept = [f for f in docs.schema.fields if f.name != out]
    schema = T.StructType([*kept, T.StructField(out, _SPANS)])
    return docs.select(*[f"`{f.name}`" for f in kept]).mapInArrow(_find(text, out), schema)


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every secret replaced by ``[SECRET]``; all else is as it was.

    Overlapping spans become one. Texts without secrets, nulls among them, are left
    alone. Of an assignment only the value goes. ``n_chars`` is counted anew where a
    text has changed.
    """
    schema = docs.schema
    counted = "n_chars" in schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            counts = batch.column(batch.schema.get_field_index("n_chars")).to_pylist() if counted else []
            changed = False
            for row, spans in enumerate(scan_block([t or "" for t in texts])):
                if spans:
                    changed = True
                    texts[row] = without(texts[row], spans)
                    if counted:
                        counts[row] = len(texts[row])
            if not changed:
                yield batch
                continue
            new = {text: pa.array(texts, pa.string())}
            if counted:
                new["n_chars"] = pa.array(counts, batch.schema.field("n_chars").type)
            yield pa.RecordBatch.from_arrays([new.get(n, batch.column(n)) for n in batch.schema.names], names=batch.schema.names)

    return docs.mapInArrow(run, schema)


def without(text: str, spans: list[Span]) -> str:
    """``text`` with the secret part of each span put out of sight."""
    cuts = []
    for start, rank, end in spans:
        rule = RULES[rank]
        if rule.group:
            start = end - len(re.compile(rule.pattern).match(text, start).group(rule.group))
        cuts.append((start, end))
    out, at = [], 0
    for start, end in sorted(cuts):
        if start >= at:
            out += [text[at:start], REDACTED]
        at = max(at, end)
    return "".join([*out, text[at:]])


def report(docs: DataFrame) -> DataFrame:
    """Counts, digest and list of the spans of each document."""
    found = find_secrets(docs.select("doc_id", "text")).select("doc_id", "secrets")
    base = F.filter("secrets", lambda s: s["kind"].isin(BASE))
    counts = [sp.count_kind(F.col("secrets"), kind).alias(f"n_{kind}") for kind in BASE]
    return found.select("doc_id", *counts, F.sha2(sp.joined(base), 256).alias("base_sha256"), sp.joined(F.col("secrets")).alias("spans"))


def sql() -> str:
    def keep(rule: Rule) -> str:
        if not rule.group:
            return f"length(value) >= {rule.least}"
        quoted = rule.pattern.replace("'", "''")
        return f"length(regexp_extract(value, '{quoted}', {rule.group})) >= {rule.least}"

    finds = [sp.sql_find("t", rule.kind, rank, rule.pattern, keep(rule)) for rank, rule in enumerate(RULES)]
    return sp.sql_report("documents", finds, BASE)
