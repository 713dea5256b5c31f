"""Boolean trigram queries from regular expressions.

A query says which three-character strings a text must hold, in lower case, for
the expression to have a match: a trigram set (all of it), an AND or an OR of
queries, ANY (no condition) or NONE (no text). It is a necessary condition only; a
text that satisfies it is a candidate.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable
from dataclasses import dataclass
from re import _constants as sre
from re import _parser

# Sets of possible strings beyond this size are given up for a plain condition.
MAX_EXACT = 64
# Larger character classes say too little to be spelled out.
MAX_CLASS = 8


@dataclass(frozen=True)
class Query:
    """``op`` is ``any``, ``none``, ``tri``, ``and`` or ``or``."""

    op: str
    trigram: str = ""
    parts: tuple[Query, ...] = ()

    def trigrams(self) -> set[str]:
        return {self.trigram} if self.op == "tri" else set().union(*(p.trigrams() for p in self.parts))

    def rows(self, posting: Callable[[str], set[int]]) -> set[int] | None:
        """Candidates by intersecting and merging postings; None stands for every row."""
        if self.op == "any":
            return None
        if self.op == "none":
            return set()
        if self.op == "tri":
            return posting(self.trigram)
        found = [p.rows(posting) for p in self.parts]
        if self.op == "or":
            return None if any(f is None for f in found) else set().union(*found)
        known = sorted((f for f in found if f is not None), key=len)
        return set.intersection(*known) if known else None


ANY, NONE = Query("any"), Query("none")


def _all(*parts: Query) -> Query:
    flat = {q for p in parts for q in (p.parts if p.op == "and" else (p,)) if q.op != "any"}
    if NONE in flat:
        return NONE
    if len(flat) < 2:
        return next(iter(flat), ANY)
    return Query("and", parts=tuple(sorted(flat, key=repr)))


def _one(*parts: Query) -> Query:
    flat = {q for p in parts for q in (p.parts if p.op == "or" else (p,)) if q.op != "none"}
    if ANY in flat:
        return ANY
    # what asks for more than another part adds nothing
    sets = {q: {q, *q.parts} - ({q} if q.op == "and" else set()) for q in flat}
    flat = {q for q in flat if not any(sets[o] < sets[q] for o in flat)}
    if len(flat) < 2:
        return next(iter(flat), NONE)
    return Query("or", parts=tuple(sorted(flat, key=repr)))


def _of(text: str) -> Query:
    return _all(*(Query("tri", text[i : i + 3]) for i in range(len(text) - 2)))


@dataclass(frozen=True)
class _Info:
    """What matches of a sub-expression look like: all of them, or how they begin and end."""

    exact: frozenset[str] | None
    prefix: frozenset[str]
    suffix: frozenset[str]
    must: Query


def _exact(strings: set[str]) -> _Info:
    return _Info(frozenset(strings), frozenset(strings), frozenset(strings), ANY)


_UNKNOWN = _Info(None, frozenset({""}), frozenset({""}), ANY)


def _condition(strings: frozenset[str]) -> Query:
    return _one(*(_of(s) for s in strings)) if strings else NONE


def _settled(info: _Info) -> Query:
    """The condition of a whole sub-expression."""
    if info.exact is not None:
        return _condition(info.exact)
    return _all(info.must, _condition(info.prefix), _condition(info.suffix))


def _loosened(info: _Info) -> _Info:
    """At most ``MAX_EXACT`` strings: long sets become conditions and short ends."""
    if info.exact is not None:
        if len(info.exact) <= MAX_EXACT:
            return info
        info = _Info(None, info.exact, info.exact, _condition(info.exact))
    prefix, suffix, must = info.prefix, info.suffix, info.must
    if len(prefix) > MAX_EXACT:
        must, prefix = _all(must, _condition(prefix)), frozenset(p[:2] for p in prefix)
        prefix = prefix if len(prefix) <= MAX_EXACT else frozenset({""})
    if len(suffix) > MAX_EXACT:
        must, suffix = _all(must, _condition(suffix)), frozenset(s[-2:] for s in suffix)
        suffix = suffix if len(suffix) <= MAX_EXACT else frozenset({""})
    return _Info(None, prefix, suffix, must)


def _concat(a: _Info, b: _Info) -> _Info:
    def times(x: frozenset[str], y: frozenset[str]) -> frozenset[str]:
        return frozenset(p + q for p, q in itertools.product(x, y))

    if a.exact is not None and b.exact is not None:
        return _loosened(_exact(times(a.exact, b.exact)))
    prefix = a.prefix if a.exact is None else times(a.exact, b.prefix)
    suffix = b.suffix if b.exact is None else times(a.suffix, b.exact)
    must = _all(a.must, b.must)
    if a.exact is None and b.exact is None:
        # strings that end the first and begin the second are side by side
        must = _all(must, _condition(times(a.suffix, b.prefix)))
    return _loosened(_Info(None, prefix, suffix, must))


def _either(a: _Info, b: _Info) -> _Info:
    if a.exact is not None and b.exact is not None:
        return _loosened(_exact(set(a.exact | b.exact)))
    must = _one(_settled(a), _settled(b))
    return _loosened(_Info(None, a.prefix | b.prefix, a.suffix | b.suffix, must))


def _characters(items: list) -> set[str] | None:
    out: set[str] = set()
    for op, value in items:
        if op is sre.LITERAL:
            out.add(chr(value).lower())
        elif op is sre.RANGE and value[1] - value[0] < MAX_EXACT:
            out.update(chr(c).lower() for c in range(value[0], value[1] + 1))
        else:
            return None
    return out


def _sequence(items) -> _Info:
    info = _exact({""})
    for op, value in items:
        info = _concat(info, _item(op, value))
    return info


def _item(op, value) -> _Info:
    if op is sre.LITERAL:
        return _exact({chr(value).lower()})
    if op is sre.IN:
        found = _characters(value)
        return _UNKNOWN if found is None or len(found) > MAX_CLASS else _exact(found)
    if op is sre.SUBPATTERN:
        return _sequence(value[-1])
    if op is sre.ATOMIC_GROUP:
        return _sequence(value)
    if op is sre.BRANCH:
        infos = [_sequence(branch) for branch in value[1]]
        whole = infos[0]
        for other in infos[1:]:
            whole = _either(whole, other)
        return whole
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
        least, most, body = value
        inner = _sequence(body)
        if least == 0:
            return _either(_exact({""}), inner) if most == 1 else _UNKNOWN
        if most == least <= 3:
            whole = inner
            for _ in range(least - 1):
                whole = _concat(whole, inner)
            return whole
        return _Info(None, inner.prefix, inner.suffix, _settled(inner))
    if op in (sre.AT, sre.ASSERT, sre.ASSERT_NOT):
        return _exact({""})
    return _UNKNOWN


def query_of(pattern: str) -> Query:
    """The Boolean trigram query of a regular expression.

    ``ANY`` where no trigram is mandatory: such an expression has to be tried on
    every text. The condition is on lower-case ASCII texts, so it also serves where
    letters are meant in either case.
    """
    return _settled(_sequence(_parser.parse(pattern, re.ASCII)))
