"""A bidirectional FM-index over a delimited vocabulary, and search schemes for one error.

The vocabulary is one cyclic text ``$word$word...$word`` in sorted order. For every pattern the
index keeps two intervals of suffix ranks, one over the text and one over its reversal, of the same
size; a pattern grows at its left end by the first and at its right end by the second, and the
other interval moves in step by the number of occurrences with a smaller character. The delimiter
sorts first, so the rank of ``$word$`` among the suffixes is the word's place in the vocabulary.

A search scheme splits a query in two halves, of which one error leaves one whole. The first
scheme matches ``$`` and the first half exactly, from the middle to the left, and goes on to the
right across the second half and ``$`` with one character inserted, deleted or replaced on the way;
the second scheme mirrors it. All queries of a batch move in step: a state is (query, place,
error left, ranks), and numpy moves all states at once. Memory follows the text (some 60 bytes a
character) and the states of one batch, whose number is bounded by the alphabet and the length of
the queries, as only characters that occur are followed.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np

REPLACE, INSERT, DELETE = 1, 2, 4
_END = 0


class Wavelet:
    """Ranks of symbols in a sequence, by one row of running bit counts per bit of a symbol."""

    def __init__(self, sequence: np.ndarray, symbols: int) -> None:
        self.levels = max(1, int(symbols - 1).bit_length())
        self.ones, self.zeros = [], []
        counts = np.bincount(sequence, minlength=1 << self.levels)
        first = np.cumsum(counts) - counts
        for level in range(self.levels - 1, -1, -1):
            bits = (sequence >> level) & 1
            self.ones.append(np.append(0, np.cumsum(bits)).astype(np.int32))
            self.zeros.append(len(bits) - int(self.ones[-1][-1]))
            sequence = np.concatenate([sequence[bits == 0], sequence[bits == 1]])
        start = np.zeros(1 << self.levels, np.int64)
        place = np.flatnonzero(np.append(True, sequence[1:] != sequence[:-1]))
        start[sequence[place]] = place
        # From the place in the lowest row to the rank among all suffixes.
        self.shift = first - start

    def extend(self, low, size, symbol):
        """(low, size, smaller) of the interval when ``symbol`` is put before its suffixes."""
        high, smaller = low + size, np.zeros_like(low)
        for row, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            bit = (symbol >> (self.levels - 1 - row)) & 1 == 1
            a, b = ones[low], ones[high]
            smaller += np.where(bit, high - low - (b - a), 0)
            low, high = np.where(bit, zeros + a, low - a), np.where(bit, zeros + b, high - b)
        return low + self.shift[symbol], high - low, smaller

    def children(self, low, size):
        """(state, symbol, low, size, smaller) of every symbol that stands before a suffix."""
        state, high = np.arange(len(low)), low + size
        symbol, smaller = np.zeros_like(low), np.zeros_like(low)
        for ones, zeros in zip(self.ones, self.zeros):
            a, b = ones[low], ones[high]
            left, right = high - low - (b - a) > 0, b > a
            state = np.concatenate([state[left], state[right]])
            smaller = np.concatenate([smaller[left], (smaller + high - low - (b - a))[right]])
            symbol = np.concatenate([symbol[left] << 1, symbol[right] << 1 | 1])
            low, high = (
                np.concatenate([(low - a)[left], (zeros + a)[right]]),
                np.concatenate([(high - b)[left], (zeros + b)[right]]),
            )
        return state, symbol, low + self.shift[symbol], high - low, smaller


def suffix_ranks(codes: np.ndarray, symbols: int) -> np.ndarray:
    """Places of the rotations of a cyclic text in sorted order, by prefix doubling."""
    n, bits = len(codes), max(1, int(symbols - 1).bit_length())
    reach = max(1, 62 // bits)
    key = np.zeros(n, np.int64)
    for step in range(reach):
        key = key << bits | np.roll(codes, -step)
    while True:
        order = np.argsort(key, kind="stable")
        new = np.append(0, np.cumsum(np.diff(key[order]) != 0))
        if new[-1] == n - 1 or reach >= 2 * n:
            return order
        rank = np.empty(n, np.int64)
        rank[order] = new
        key = rank * n + np.roll(rank, -reach)
        reach *= 2


@dataclass
class States:
    """Patterns in the making: their queries, the next place in them, errors made, and ranks."""

    query: np.ndarray
    place: np.ndarray
    error: np.ndarray
    low: np.ndarray
    back: np.ndarray
    size: np.ndarray

    def __len__(self) -> int:
        return len(self.query)

    def where(self, mask) -> States:
        return States(*(column[mask] for column in self.columns()))

    def columns(self) -> tuple[np.ndarray, ...]:
        return self.query, self.place, self.error, self.low, self.back, self.size

    @staticmethod
    def joined(parts: Sequence[States]) -> States:
        return States(*(np.concatenate(c) for c in zip(*(p.columns() for p in parts))))


class BidirectionalIndex:
    """The index of distinct, non-empty words, given in sorted order."""

    def __init__(self, words: Sequence[str]) -> None:
        self.words = words
        joined = "\0" + "\0".join(words)
        points = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        self.alphabet, codes = np.unique(points, return_inverse=True)
        codes, symbols = codes.astype(np.int64), len(self.alphabet)
        self.length = len(codes)
        self.left = Wavelet(codes[suffix_ranks(codes, symbols) - 1], symbols)
        codes = codes[::-1].copy()
        self.right = Wavelet(codes[suffix_ranks(codes, symbols) - 1], symbols)

    def near(
        self, queries: Sequence[str], edits: np.ndarray, batch: int = 2048
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, word) places of words one edit away; ``edits`` has the kinds that a query allows.

        A replacement keeps the length, an insertion finds words longer by one, a deletion words
        shorter by one. Queries have two characters or more. Each pair comes once.
        """
        for start in range(0, len(queries) if len(self.words) else 0, batch):
            some = queries[start : start + batch]
            run = _Batch(self, some, np.asarray(edits[start : start + batch]))
            found = np.concatenate([run.scheme(to_right=True), run.scheme(to_right=False)])
            found = np.unique(found)
            yield start + found // len(self.words), found % len(self.words)


class _Batch:
    def __init__(self, index: BidirectionalIndex, queries: Sequence[str], edits) -> None:
        self.index, self.edits = index, edits
        points = np.frombuffer("".join(queries).encode("utf-32-le"), "<u4")
        at = np.searchsorted(index.alphabet, points)
        at[at == len(index.alphabet)] = 0
        self.codes = np.where(index.alphabet[at] == points, at, -1)  # -1: in no word
        self.lengths = np.array([len(q) for q in queries], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def _grow(self, states: States, symbol, to_right: bool) -> States:
        """The states with a symbol put at one end; those that nothing matches go."""
        known = symbol >= 0
        states, symbol = states.where(known), symbol[known]
        if to_right:
            back, size, smaller = self.index.right.extend(states.back, states.size, symbol)
            low = states.low + smaller
        else:
            low, size, smaller = self.index.left.extend(states.low, states.size, symbol)
            back = states.back + smaller
        grown = States(states.query, states.place, states.error, low, back, size)
        return grown.where(size > 0)

    def _symbol(self, query, place):
        """Code at a place of a query; the delimiter at both of its ends."""
        inside = (place >= 0) & (place < self.lengths[query])
        at = np.where(inside, self.starts[query] + place, 0)
        return np.where(inside, self.codes[at], _END)

    def _anchored(self, to_right: bool) -> States:
        """States that match the half behind the middle, and the delimiter beyond it."""
        n, middle = len(self.lengths), self.lengths // 2
        step, zero = (-1, np.zeros(n, np.int64)) if to_right else (1, np.zeros(n, np.int64))
        states = States(
            np.arange(n),
            middle - 1 if to_right else middle.copy(),
            zero,
            zero.copy(),
            zero.copy(),
            np.full(n, self.index.length, np.int64),
        )
        done = []
        while len(states):
            ends = (states.place < 0) | (states.place >= self.lengths[states.query])
            symbol = self._symbol(states.query, states.place)
            done.append(self._grow(states.where(ends), symbol[ends], not to_right))
            states = self._grow(states.where(~ends), symbol[~ends], not to_right)
            states.place = states.place + step
        anchored = States.joined(done)
        half = middle[anchored.query]
        anchored.place = half if to_right else half - 1
        return anchored

    def scheme(self, to_right: bool) -> np.ndarray:
        """query * words + word of all matches with one error in the half ahead."""
        step = 1 if to_right else -1
        states, found = self._anchored(to_right), []
        while len(states):
            query, place = states.query, states.place
            symbol = self._symbol(query, place)
            ends = (place < 0) | (place >= self.lengths[query])
            clean = states.error == 0
            # A word without an error is the query itself; the others are whole at the delimiter.
            closing = ends & ~clean
            whole = self._grow(states.where(closing), symbol[closing], to_right)
            found.append(whole.query * len(self.index.words) + whole.low)
            onward = self._grow(states.where(~ends), symbol[~ends], to_right)
            onward.place = onward.place + step
            states = States.joined(
                [onward, *self._errors(states.where(clean), symbol[clean], ends[clean], step)]
            )
        return np.concatenate(found) if found else np.zeros(0, np.int64)

    def _errors(self, states: States, symbol, ends, step: int) -> list[States]:
        """All ways to make the error at the states' places."""
        if not len(states):
            return []
        allowed, ahead = self.edits[states.query], states.place + step
        # Of a run of equal characters the last one is left out or doubled, so each way is one.
        drop = ~ends & (allowed & DELETE > 0) & (self._symbol(states.query, ahead) != symbol)
        dropped = states.where(drop)
        dropped.place = dropped.place + step
        wavelet = self.index.right if step > 0 else self.index.left
        at, main = (states.back, states.low) if step > 0 else (states.low, states.back)
        state, child, at, size, smaller = wavelet.children(at, states.size)
        main = main[state] + smaller
        low, back = (main, at) if step > 0 else (at, main)
        made = States(states.query[state], states.place[state], None, low, back, size)
        made.error = np.ones_like(made.place)
        other = (child != _END) & (child != symbol[state])
        put = made.where(other & (allowed[state] & INSERT > 0))
        swap = made.where(other & ~ends[state] & (allowed[state] & REPLACE > 0))
        swap.place = swap.place + step
        dropped.error = np.ones_like(dropped.place)
        return [dropped, put, swap]
