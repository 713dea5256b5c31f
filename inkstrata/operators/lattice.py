"""Pieces in a double-array trie, and the splits of many words into them at a time.

A place of the lattice is a character boundary of a word, an edge a piece that lies
between two of them. Words of like length are walked side by side: from each place all
words step through the trie together, as long as one of them is on a path.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from functools import cached_property

import numpy as np

# Longest piece, score of a character that is no piece.
MAX_PIECE = 16
UNKNOWN_LOG_PROB = -20.0
# Widths of the tables in which words stand side by side; longer words are taken one by one.
WIDTHS = (4, 8, 12, 16, 24, 32, 48, 64)
SIDE_BY_SIDE = 8192


class Trie:
    """``base`` and ``check`` of a double array over character classes, ``piece`` at its states.

    The child of state ``s`` by class ``c`` is ``base[s] + c`` if ``check`` names ``s``
    there. State 0 is the root; class 0 is that of characters no piece has.
    """

    def __init__(self, pieces: list[str]):
        letters = sorted({c for p in pieces for c in p})
        self.classes = np.zeros(max(map(ord, letters), default=0) + 2, np.int32)
        for i, c in enumerate(letters, start=1):
            self.classes[ord(c)] = i
        number = {c: i for i, c in enumerate(letters, start=1)}
        root: dict = {}
        for i, p in enumerate(pieces):
            node = root
            for c in p:
                node = node.setdefault(number[c], {})
            node[0] = i
        self._place(root, len(letters))
        self.depth = max(map(len, pieces), default=0)

    def _place(self, root: dict, letters: int) -> None:
        size = 4 * (letters + 2)
        base, check, piece = [0] * size, [-1] * size, [-1] * size
        check[0] = 0
        # where nodes of as many children have found no place before
        tried: dict[int, int] = {}
        waiting = [(0, root)]
        while waiting:
            state, node = waiting.pop()
            piece[state] = node.get(0, -1)
            steps = sorted(c for c in node if c)
            if not steps:
                continue
            many = min(len(steps), 16)
            at = max(1, tried.get(many, 1) - steps[0])
            while True:
                if at + steps[-1] >= len(check):
                    more = len(check)
                    base += [0] * more
                    check += [-1] * more
                    piece += [-1] * more
                if all(check[at + c] < 0 for c in steps):
                    break
                at += 1
            base[state] = at
            tried[many] = at + steps[0]
            for c in steps:
                check[at + c] = state
            waiting += [(at + c, node[c]) for c in steps]
        # a step from any state stays inside
        pad = letters + 2
        self.base = np.array(base + [0] * pad, np.int32)
        self.check = np.array(check + [-1] * pad, np.int32)
        self.piece = np.array(piece + [-1] * pad, np.int32)

    def going_on(self, states: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which states have a next one, and the next one of all, if there is one."""
        at = self.base[states] + classes
        return (self.check[at] == states) & (classes > 0), at

    def step(self, states: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """The next states, -1 where there is none."""
        on, at = self.going_on(states, classes)
        return np.where(on, at, -1)


# The plain form, for one word; long words have more places than there are words to share them.
def _edges(word: str, model: dict[str, float]) -> list[list[tuple[int, str, float]]]:
    """Pieces that end at each place of the word, as (start, piece, score)."""
    ending: list[list[tuple[int, str, float]]] = [[] for _ in range(len(word) + 1)]
    for i in range(len(word)):
        for j in range(i + 1, min(len(word), i + MAX_PIECE) + 1):
            score = model.get(word[i:j])
            if score is None and j == i + 1:
                score = UNKNOWN_LOG_PROB
            if score is not None:
                ending[j].append((i, word[i:j], score))
    return ending


def _log_add(a: float, b: float) -> float:
    if a == -math.inf:
        return b
    top = max(a, b)
    return top + math.log1p(math.exp(min(a, b) - top))


def expected_pieces(word: str, model: dict[str, float]) -> dict[str, float]:
    """How often each piece occurs, on average over all ways to split the word."""
    ending = _edges(word, model)
    forward = [0.0] + [-math.inf] * len(word)
    for j in range(1, len(word) + 1):
        for i, _, score in ending[j]:
            forward[j] = _log_add(forward[j], forward[i] + score)
    backward = [-math.inf] * len(word) + [0.0]
    out: dict[str, float] = defaultdict(float)
    for j in range(len(word), 0, -1):
        for i, piece, score in ending[j]:
            out[piece] += math.exp(forward[i] + score + backward[j] - forward[-1])
            backward[i] = _log_add(backward[i], backward[j] + score)
    return out


def best_split(word: str, model: dict[str, float], without: str | None = None) -> tuple[float, list[str]]:
    """The likeliest pieces of a word and their score."""
    ending = _edges(word, model)
    best: list[tuple[float, int, str]] = [(0.0, 0, "")] + [(-math.inf, 0, "")] * len(word)
    for j in range(1, len(word) + 1):
        for i, piece, score in ending[j]:
            if piece != without and best[i][0] + score > best[j][0]:
                best[j] = (best[i][0] + score, i, piece)
    parts: list[str] = []
    j = len(word)
    while j > 0 and best[j][2]:
        parts.append(best[j][2])
        j = best[j][1]
    return best[-1][0], parts[::-1]


def tables(words: list[str], trie: Trie) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Words of like width as ``rows, classes, lengths``, the longest first; none of the long words."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(lengths, kind="stable")
    at = int(np.searchsorted(lengths[order], 1))
    last = int(np.searchsorted(lengths[order], WIDTHS[-1], "right"))
    while at < last:
        width = next(w for w in WIDTHS if w >= lengths[order[at]])
        to = min(at + SIDE_BY_SIDE, int(np.searchsorted(lengths[order], width, "right")))
        rows = order[at:to][::-1]
        codes = np.zeros((len(rows), width), np.int64)
        joined = np.frombuffer("".join(words[i] for i in rows.tolist()).encode("utf-32-le", "surrogatepass"), "<u4")
        codes[np.arange(width) < lengths[rows][:, None]] = joined
        classes = trie.classes[np.minimum(codes, len(trie.classes) - 1)]
        yield rows, classes, lengths[rows]
        at = to


def edges(trie: Trie, classes: np.ndarray, lengths: np.ndarray, unknown: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``from, to, rows, pieces`` of all edges by rising place; ``unknown`` where a character is no piece."""
    columns, width = np.ascontiguousarray(classes.T), classes.shape[1]
    # rows of each length or a greater one; they come first
    reach = np.searchsorted(-lengths, -np.arange(width + 1), "right")
    for place in range(width):
        rows = np.arange(reach[place + 1])
        if not len(rows):
            return
        states, every = np.zeros(len(rows), np.int32), rows
        for to in range(place + 1, min(place + max(trie.depth, 1), width) + 1):
            inside = np.searchsorted(rows, reach[to])
            rows = rows[:inside]
            on, states = trie.going_on(states[:inside], columns[to - 1][rows])
            rows, states = rows[on], states[on]
            found = trie.piece[states]
            has = found >= 0
            if to == place + 1:
                pieces = np.full(len(every), unknown, np.int32)
                pieces[rows[has]] = found[has]
                yield place, to, every, pieces
            elif has.any():
                yield place, to, rows[has], found[has]
            if not len(rows):
                break


class Lattice:
    """A unigram model over pieces: likeliest splits and expected counts."""

    def __init__(self, model: dict[str, float], pieces: list[str] | None = None, trie: Trie | None = None):
        """``pieces`` with their ``trie`` are those of an earlier model that held all of this one's."""
        self.model = model
        self.pieces = list(model) if pieces is None else pieces
        self.trie = trie or Trie(self.pieces)
        # the last score is that of a character that is no piece
        self.scores = np.array([*(model.get(p, -np.inf) for p in self.pieces), UNKNOWN_LOG_PROB])

    @cached_property
    def number(self) -> dict[str, int]:
        return {p: i for i, p in enumerate(self.pieces)}

    def _edges(self, classes: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        for start, end, rows, found in edges(self.trie, classes, lengths, len(self.pieces)):
            if end == start + 1:
                found = np.where(self.scores[found] == -np.inf, len(self.pieces), found)
            else:
                held = self.scores[found] > -np.inf
                rows, found = rows[held], found[held]
            yield start, end, rows, found

    def best(self, words: list[str], whole: bool = True) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """``rows, scores, pieces``: the likeliest splits, table by table, long words alone.

        ``pieces`` holds the numbers of the pieces of each row from left to right behind
        as many -1 as it takes; ``len(self.pieces)`` stands for a character that is no
        piece. Of equal splits the one whose last pieces are longer counts. Without
        ``whole``, no split is the word itself.
        """
        for rows, classes, lengths in tables(words, self.trie):
            count, width = classes.shape
            best = np.full((count, width + 1), -np.inf)
            best[:, 0] = 0.0
            back, by = np.zeros((count, width + 1), np.int32), np.full((count, width + 1), -1, np.int32)
            for start, end, own, found in self._edges(classes, lengths):
                if not whole and start == 0:
                    keep = lengths[own] != end
                    own, found = own[keep], found[keep]
                score = best[own, start] + self.scores[found]
                better = score > best[own, end]
                own, found = own[better], found[better]
                best[own, end] = score[better]
                back[own, end], by[own, end] = start, found
            pieces = np.full((count, width), -1, np.int32)
            every, at, column = np.arange(count), lengths.copy(), width
            while True:
                open_ = at > 0
                if not open_.any() or column == 0:
                    break
                column -= 1
                pieces[:, column] = np.where(open_, by[every, at], -1)
                at = np.where(open_, back[every, at], 0)
            yield rows, best[np.arange(count), lengths], pieces
        for row in _long(words):
            score, parts = best_split(words[row], self.model, None if whole else words[row])
            yield np.array([row]), np.array([score]), np.array([[self.number.get(p, len(self.pieces)) for p in parts]], np.int32)

    def expected(self, words: list[str], counts: np.ndarray) -> np.ndarray:
        """How often each piece occurs in all splits of the words, by their probability and count."""
        out = np.zeros(len(self.scores))
        for rows, classes, lengths in tables(words, self.trie):
            count, width = classes.shape
            ahead = np.full((width + 1, count), -np.inf)
            ahead[0] = 0.0
            found = [(start, end, own, pieces, self.scores[pieces]) for start, end, own, pieces in self._edges(classes, lengths)]
            for start, end, own, _, scores in found:
                ahead[end][own] = np.logaddexp(ahead[end][own], ahead[start][own] + scores)
            behind = np.full((width + 1, count), -np.inf)
            every = np.arange(count)
            behind[lengths, every] = 0.0
            total, weight = ahead[lengths, every], counts[rows]
            for start, end, own, pieces, scores in reversed(found):
                way = scores + behind[end][own]
                share = np.exp(ahead[start][own] + way - total[own])
                out += np.bincount(pieces, weights=share * weight[own], minlength=len(out))
                behind[start][own] = np.logaddexp(behind[start][own], way)
        for row in _long(words):
            for piece, share in expected_pieces(words[row], self.model).items():
                out[self.number.get(piece, len(self.pieces))] += share * counts[row]
        return out


def _long(words: list[str]) -> list[int]:
    return [i for i, word in enumerate(words) if len(word) > WIDTHS[-1]]
