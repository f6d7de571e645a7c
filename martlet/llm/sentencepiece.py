"""SentencePiece encoding and decoding by a streaming Viterbi search.

The search walks over the characters and keeps, for each boundary of the last few, the best way
to cut the text there: its backpointer is the piece that ends at the boundary. The window is as
long as the longest piece, as no piece can reach back further. Whenever all surviving
backpointer paths pass one boundary, everything before it is settled, its ids are committed and
the window moves on; memory does not grow with the text.

What "best" means depends on the model, whose pieces and scores are read from its file:

* Unigram: the largest sum of scores.
* BPE: scores are merge ranks and do not add up. A sequence of pieces is the BPE encoding
  exactly if every piece encodes to itself and every two neighbours stay apart when merged on
  their own; so a path survives if its neighbours are compatible, and the others score minus
  infinity. Each boundary then has one surviving path, and the ids equal the merge procedure's.

Text is cut before each space that follows another character, since no piece continues across
one; equal words are looked up in a bounded cache that the tasks of a process share.

Defined results: null text gives null ids, empty text no ids. Characters without a piece become
byte pieces, or the unknown id if the model has none. Pieces write the space as U+2581; that
character itself is written in bytes, so decoding returns every text exactly where the model has
byte pieces. Texts of any length are read whole; repeated rows give equal ids.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cached_property
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StructType

SPACE = " "
_SPACE_IN_PIECES = "▁"
_CACHED_LENGTH = 64
_CACHED_UNITS = 400_000  # some 150 bytes each
_CACHED_PAIRS = 1 << 17
_SLICE = 1 << 20
_WORDS_AT_ONCE = 8192
_NEVER = float("-inf")
_START = (0.0, 0, -1)


@dataclass
class PieceModel:
    """Pieces of a SentencePiece model as plain data, their spaces written as spaces."""

    pieces: list[str]
    scores: list[float]
    byte_ids: list[int]
    unknown: int
    kind: str
    dummy_prefix: bool = True
    fingerprint: str = ""
    _merged: dict[str, tuple[int, ...]] = field(default_factory=dict, repr=False, compare=False)
    _grown: dict[tuple[int, int], list] = field(default_factory=dict, repr=False, compare=False)
    known_pairs: dict[int, bool] = field(default_factory=dict, repr=False, compare=False)

    @cached_property
    def ids(self) -> dict[str, int]:
        """Ids of the pieces that text can turn into."""
        closed = {self.unknown, *self.byte_ids}
        return {
            piece: i
            for i, piece in enumerate(self.pieces)
            if i not in closed and self.scores[i] is not None
        }

    @cached_property
    def endings(self) -> dict[str, int]:
        """Every ending of a piece with its id, or -1 if it is no piece itself."""
        found = {piece[i:]: -1 for piece in self.ids for i in range(len(piece))}
        return found | self.ids

    @cached_property
    def joined(self) -> set[str]:
        """The pairs of neighbouring characters inside pieces; no piece crosses any other pair."""
        return {piece[i : i + 2] for piece in self.ids for i in range(len(piece) - 1)}

    @cached_property
    def longest(self) -> int:
        return max(map(len, self.ids), default=1)

    @property
    def window(self) -> int:
        """Characters after which the search looks for a boundary to settle."""
        return 4 * self.longest

    def spelled(self, char: str) -> list[int]:
        """Ids of a character that has no piece."""
        return [self.byte_ids[b] for b in char.encode()] if self.byte_ids else [self.unknown]

    def merge(self, text: str) -> tuple[int, ...]:
        """The merge procedure on a short text of known characters, the definition of BPE."""
        if (known := self._merged.get(text)) is None:
            parts = list(text)
            while len(parts) > 1:
                at, joint = self._next_merge(parts)
                if joint is None:
                    break
                parts[at : at + 2] = [self.pieces[joint]]
            known = self._merged[text] = tuple(self.ids.get(part, -1) for part in parts)
        return known

    def whole(self, token: int) -> bool:
        """Whether the merge procedure can make the piece from its characters."""
        return self.merge(self.pieces[token]) == (token,)

    def apart(self, left: int, right: int) -> bool:
        """Whether the merge procedure keeps two neighbouring pieces as they are."""
        key = left << 32 | right
        if (known := self.known_pairs.get(key)) is None:
            if len(self.known_pairs) >= _CACHED_PAIRS:
                self.known_pairs.clear()
            if SPACE * 2 in self.pieces[left] + self.pieces[right]:  # runs have equal ranks
                joint = self.merge(self.pieces[left] + self.pieces[right])
                known = joint == (left, right)
            else:
                known = not self._crosses(self._growth(left, -1), self._growth(right, 0))
            self.known_pairs[key] = known
        return known

    def _crosses(self, left: list[tuple[float, str]], right: list[tuple[float, str]]) -> bool:
        """Whether the parts at a seam merge before both have grown into their whole pieces."""
        ids, scores = self.ids, self.scores
        i = j = 0
        while True:
            joint = ids.get(left[i][1] + right[j][1])
            across = _NEVER if joint is None else scores[joint]
            on_left = left[i + 1][0] if i + 1 < len(left) else _NEVER
            on_right = right[j + 1][0] if j + 1 < len(right) else _NEVER
            if across > on_left and across >= on_right:  # of equal ranks, the leftmost is first
                return True
            if on_left == on_right == _NEVER:
                return False
            if on_left >= on_right:
                i += 1
            else:
                j += 1

    def _growth(self, token: int, end: int) -> list[tuple[float, str]]:
        """How the part at one end of a piece grows: (score of the merge, part), first to last."""
        if (known := self._grown.get((token, end))) is None:
            parts, known = list(self.pieces[token]), []
            known.append((0.0, parts[end]))
            while len(parts) > 1:
                at, joint = self._next_merge(parts)
                parts[at : at + 2] = [self.pieces[joint]]
                if parts[end] != known[-1][1]:
                    known.append((self.scores[joint], parts[end]))
            self._grown[token, end] = known
        return known

    def _next_merge(self, parts: list[str]) -> tuple[int, int | None]:
        """(place, piece) of the merge with the best score, the leftmost of equals."""
        joint = [self.ids.get(a + b) for a, b in zip(parts, parts[1:], strict=False)]
        ranks = [_NEVER if i is None else self.scores[i] for i in joint]
        at = max(range(len(ranks)), key=ranks.__getitem__)
        return at, joint[at]


def load_model(path: str | Path, kind: str = "bpe", dummy_prefix: bool = True) -> PieceModel:
    """Read pieces and scores of a model file; ``kind`` is ``bpe`` or ``unigram``."""
    import sentencepiece

    if kind not in ("bpe", "unigram"):
        raise ValueError(f"unknown kind of model: {kind}")
    source = sentencepiece.SentencePieceProcessor(model_file=str(path))
    size = source.get_piece_size()
    closed = [source.is_control(i) or source.is_unused(i) for i in range(size)]
    found = {int(source.id_to_piece(i)[1:-1], 16): i for i in range(size) if source.is_byte(i)}
    content = hashlib.sha256(source.serialized_model_proto()).hexdigest()
    return PieceModel(
        [source.id_to_piece(i).replace(_SPACE_IN_PIECES, SPACE) for i in range(size)],
        [None if closed[i] else source.get_score(i) for i in range(size)],
        [found[b] for b in range(256)] if len(found) == 256 else [],
        source.unk_id(),
        kind,
        dummy_prefix,
        f"{content} {kind} {dummy_prefix}",
    )


class StreamingViterbi:
    """The search over one stretch of text; feed it in parts, take the ids that are settled."""

    def __init__(self, model: PieceModel) -> None:
        self.model = model
        self.bpe = model.kind == "bpe"
        self.text = ""  # the characters behind the settled boundary
        self.nodes: list[tuple | None] = [_START]  # (score, where its piece begins, the piece)

    def feed(self, part: str) -> list[int]:
        """Take more characters; the ids that no later character can change."""
        ending, longest, window = self.model.endings.get, self.model.longest, self.model.window
        settled, nodes = [], self.nodes
        text, end = self.text + part, len(self.text)
        while end < len(text):
            end += 1
            found = []
            for start in range(end - 1, max(-1, end - 1 - longest), -1):
                token = ending(text[start:end])
                if token is None:
                    break
                if token >= 0 and nodes[start] is not None:
                    found.append((start, token))
            best = self._best(found) if found else None
            if best is None and text[end - 1] not in self.model.ids:
                # No piece holds this character, so every path passes both of its sides.
                settled += self._path(end - 1) + self.model.spelled(text[end - 1])
                text, end, nodes = text[end:], 0, [_START]
                self.nodes = nodes
                continue
            nodes.append(best)
            if end >= window and (meeting := self._meeting(end)):
                settled += self._path(meeting)
                text, end = text[meeting:], end - meeting
                nodes = self._from(meeting)
        self.text = text
        return settled

    def _best(self, found: list[tuple[int, int]]) -> tuple | None:
        """The best way to reach a boundary, out of (where a last piece begins, the piece)."""
        nodes, model = self.nodes, self.model
        if not self.bpe:
            return max((nodes[at][0] + model.scores[token], at, token) for at, token in found)
        known = model.known_pairs
        for at, token in reversed(found):
            left = nodes[at][2]
            apart = known.get(left << 32 | token) if left >= 0 else model.whole(token)
            if apart is None:
                apart = model.apart(left, token)
            if apart:
                return (0.0, at, token)
        return None

    def rest(self) -> list[int]:
        """The ids of the characters behind the settled boundary, if the stretch ends here."""
        return self._path(len(self.text))

    def rewind(self, length: int) -> None:
        """Forget all but the first characters behind the settled boundary."""
        self.text = self.text[:length]
        del self.nodes[length + 1 :]

    def _path(self, end: int) -> list[int]:
        ids = []
        while end:
            _, end, token = self.nodes[end]
            ids.append(token)
        return ids[::-1]

    def _meeting(self, end: int) -> int:
        """The last boundary that all paths within a piece's reach of the end go through."""
        alive = {at for at in range(end - self.model.longest + 1, end + 1) if self.nodes[at]}
        while len(alive) > 1:
            latest = max(alive)
            alive.discard(latest)
            alive.add(self.nodes[latest][1])
        return alive.pop()

    def _from(self, meeting: int) -> list[tuple | None]:
        """Forget what lies before a boundary, but for the score and piece that lead to it."""
        score, _, token = self.nodes[meeting]
        later = [n and (n[0], n[1] - meeting, n[2]) for n in self.nodes[meeting + 1 :]]
        self.nodes = [(score, 0, token), *later]
        return self.nodes


class Table:
    """Small numbers by whole-number keys, asked and taken in many at a time.

    An open-addressed array whose entries hold the key above the value's bits.
    """

    def __init__(self, value_bits: int, room: int = 1 << 12) -> None:
        self.bits, self.count = value_bits, 0
        self.entries = np.full(1 << (4 * room - 1).bit_length(), -1, np.int64)

    def places(self, keys: np.ndarray) -> np.ndarray:
        """Where a search for each key begins."""
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(65 - len(self.entries).bit_length())).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, or -1."""
        at, last = self.places(keys), len(self.entries) - 1
        entry = self.entries[at]
        values = np.where(entry >> self.bits == keys, entry & (1 << self.bits) - 1, -1)
        left = np.flatnonzero((values < 0) & (entry >= 0))
        while len(left):
            at[left] = at[left] + 1 & last
            entry = self.entries[at[left]]
            here = entry >> self.bits == keys[left]
            values[left[here]] = entry[here] & (1 << self.bits) - 1
            left = left[~here & (entry >= 0)]
        return values

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Take in distinct keys that are not there yet."""
        if 2 * (self.count + len(keys)) > len(self.entries):
            old, grown = self.entries[self.entries >= 0], Table(self.bits, self.count + len(keys))
            grown.put(old >> self.bits, old & (1 << self.bits) - 1)
            self.entries = grown.entries
        self.count += len(keys)
        new, at, last = keys << self.bits | values, self.places(keys), len(self.entries) - 1
        while len(new):
            free = self.entries[at] < 0
            self.entries[at[free]] = new[free]  # of several, one stays
            left = self.entries[at] != new
            new, at = new[left], at[left] + 1 & last


class PieceTrie:
    """The pieces as a trie whose edges are one table, so that many steps are one look."""

    def __init__(self, model: PieceModel) -> None:
        letters = sorted({char for piece in model.ids for char in piece})
        self.points = np.array([ord(char) for char in letters] or [0], np.int64)
        place = {char: i for i, char in enumerate(letters)}
        nodes: dict[int, int] = {}
        tokens = [-1]
        for piece, token in model.ids.items():
            at = 0
            for char in piece:
                edge = at * len(letters) + place[char]
                if (to := nodes.get(edge)) is None:
                    to = nodes[edge] = len(tokens)
                    tokens.append(-1)
                at = to
            tokens[at] = token
        self.edges = Table(len(tokens).bit_length(), len(tokens))
        self.edges.put(
            np.fromiter(nodes.keys(), np.int64, len(nodes)),
            np.fromiter(nodes.values(), np.int64, len(nodes)),
        )
        self.tokens = np.array(tokens, np.int64)
        every = np.arange(len(letters))
        self.first = self.step(np.zeros(len(letters), np.int64), every)  # from the root

    def letters(self, words: list[str]) -> np.ndarray:
        """Places of the characters of the joined words in the trie's alphabet, or -1."""
        points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
        points = points.astype(np.int64)
        at = np.minimum(np.searchsorted(self.points, points), len(self.points) - 1)
        return np.where(self.points[at] == points, at, -1)

    def step(self, nodes: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """The nodes that the letters lead to, or -1."""
        return self.edges.get(nodes * len(self.points) + letters)


class Pairs:
    """What ``apart`` says of pairs of pieces, for many pairs at a time; bounded."""

    def __init__(self, model: PieceModel) -> None:
        self.model, self.known = model, Table(1)

    def look(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether the pieces stay apart; a left piece of -1 asks whether the right one is whole."""
        keys = (left + 1) << 31 | right
        apart = self.known.get(keys)
        if len(missing := np.flatnonzero(apart < 0)):
            new, place = np.unique(keys[missing], return_inverse=True)
            found = self._learn(new)
            apart[missing] = found[place]
            if self.known.count + len(new) > 4 * _CACHED_PAIRS:
                self.known = Table(1)
            self.known.put(new, found)
        return apart == 1

    def _learn(self, new: np.ndarray) -> np.ndarray:
        model = self.model
        found = [
            model.apart(left - 1, right) if left else model.whole(right)
            for left, right in zip((new >> 31).tolist(), (new & 0x7FFFFFFF).tolist())
        ]
        return np.array(found, np.int64)


class WordSearch:
    """The search over many short words at once, for models of the BPE kind.

    Words lie one behind the other, the longest first, and all take a step together. For each
    boundary, the pieces that end there come from trie positions that started within a piece's
    reach, and the one whose neighbours stay apart is the boundary's backpointer. A short word
    ends within the window of the search over long stretches, so nothing needs to be committed
    before its end.
    """

    def __init__(self, model: PieceModel) -> None:
        self.model, self.trie, self.pairs = model, PieceTrie(model), Pairs(model)
        self.single = np.zeros(len(self.trie.points) + 1, bool)  # the last: not in the trie
        for i, point in enumerate(self.trie.points.tolist()):
            self.single[i] = chr(point) in model.ids

    def encode(self, words: list[str]) -> Iterator[tuple[str, bytes | None]]:
        """Each word with its ids; None if a character has no piece of its own."""
        words = sorted(words, key=len, reverse=True)
        for start in range(0, len(words), _WORDS_AT_ONCE):
            some = words[start : start + _WORDS_AT_ONCE]
            yield from zip(some, self._encode(some))

    def _encode(self, words: list[str]) -> list[bytes | None]:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        letters = self.trie.letters(words)
        unknown = np.concatenate([[0], np.cumsum(~self.single[letters])])
        ends = np.cumsum(sizes)
        known = unknown[ends] == unknown[ends - sizes]
        letters, rows = letters[np.repeat(known, sizes)], np.flatnonzero(known)
        sizes = sizes[rows]
        token, back = self._search(letters, sizes)
        first = np.cumsum(sizes + 1) - sizes - 1
        owner, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        at = np.arange(len(rows))
        place = first + sizes
        while len(at):
            found.append(token[place])
            owner.append(at)
            place = back[place]
            more = place > first[at]
            at, place = at[more], place[more]
        # From the last piece to the first: turned round, and brought together by word.
        owner = np.concatenate(owner[::-1])
        order = np.argsort(owner, kind="stable")
        data = np.concatenate(found[::-1])[order].astype(np.int32).tobytes()
        ends = 4 * np.cumsum(np.bincount(owner, minlength=len(rows)))
        result: list[bytes | None] = [None] * len(words)
        for row, a, b in zip(rows.tolist(), [0, *ends.tolist()], ends.tolist()):
            result[row] = data[a:b]
        return result

    def _search(self, letters: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per word and boundary the piece that ends there and the boundary where it begins."""
        n = len(sizes)
        letter_at = np.cumsum(sizes) - sizes
        first = letter_at + np.arange(n)
        token = np.full(len(letters) + n, -2, np.int64)  # -2: no path ends here
        back = np.zeros(len(token), np.int64)
        token[first] = -1
        row, start, node = (np.zeros(0, np.int64) for _ in range(3))
        longer = n - np.cumsum(np.bincount(sizes)) if n else sizes
        for end in range(1, len(longer)):
            m = longer[end - 1]  # words that reach this boundary
            letter = letters[letter_at[:m] + end - 1]
            on = np.flatnonzero(row < m)
            row, start = row[on], start[on]
            node = np.concatenate([self.trie.step(node[on], letter[row]), self.trie.first[letter]])
            alive = np.flatnonzero(node >= 0)
            row = np.concatenate([row, np.arange(m)])[alive]
            start = np.concatenate([start, first[:m] + end - 1])[alive]
            node = node[alive]
            piece = self.trie.tokens[node]
            left = token[start]
            ends = np.flatnonzero((piece >= 0) & (left >= -1))
            fits = ends[self.pairs.look(left[ends], piece[ends])]
            fits = fits[::-1]  # of several, the longest is written last
            to = first[row[fits]] + end
            token[to], back[to] = piece[fits], start[fits]
        return token, back


class Encoder:
    """Encodes and decodes texts; words that come again are looked up."""

    _of_model: dict[str, Encoder] = {}

    def __init__(self, model: PieceModel) -> None:
        self.model = model
        self.units = _Units(model)
        pieces = [piece.encode() for piece in model.pieces]
        for value, i in enumerate(model.byte_ids):
            pieces[i] = bytes([value])
        self.spelled = pa.array(pieces, pa.large_binary())

    @classmethod
    def of(cls, model: PieceModel) -> Encoder:
        """The encoder of this process; tasks that follow each other share what it has seen."""
        if model.fingerprint not in cls._of_model:
            cls._of_model.clear()
            cls._of_model[model.fingerprint] = cls(model)
        return cls._of_model[model.fingerprint]

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text as int32."""
        units = self._cut(text)
        return np.frombuffer(b"".join(map(self.units.__getitem__, units)), np.int32)

    def encode_all(self, texts: Iterable[str | None]) -> Iterator[np.ndarray | None]:
        """Ids of each text; the new words of a slice of texts are searched together."""
        held, size = [], 0
        for text in texts:
            held.append(text)
            size += len(text or "")
            if size > _SLICE:
                yield from self._rows(held)
                held, size = [], 0
        yield from self._rows(held)

    def _rows(self, texts: list[str | None]) -> Iterator[np.ndarray | None]:
        found = self.encode_column(pa.array(texts, pa.large_string()))
        ids, ends = found.values.to_numpy(), found.offsets.to_pylist()
        for text, a, b in zip(texts, ends, ends[1:]):
            yield None if text is None else ids[a:b]

    def encode_column(self, texts: pa.Array) -> pa.ListArray:
        """Ids of a column of texts; each of its units is looked up once, however often it comes."""
        full = pc.greater(pc.fill_null(pc.binary_length(texts), 0), 0)
        some = texts.filter(full).cast(pa.large_string())
        if self.model.dummy_prefix:
            none, space = (pa.scalar(part, some.type) for part in ("", SPACE))
            some = pc.binary_join_element_wise(none, some, space)
        starts, units = _units_of(some)
        told = units.dictionary_encode()
        found = self.units.of(told.dictionary.to_numpy(zero_copy_only=False).tolist())
        ends = np.cumsum([0, *map(len, found)]) // 4
        values = pa.array(np.frombuffer(b"".join(found), np.int32))
        ids = pa.LargeListArray.from_arrays(pa.array(ends), values).take(told.indices)
        ends = np.zeros(len(texts) + 1, np.int64)
        sizes = np.diff(ids.offsets.to_numpy()[starts])
        ends[1:][full.to_numpy(zero_copy_only=False)] = sizes
        ends = pa.array(np.cumsum(ends), pa.int32())
        return pa.ListArray.from_arrays(ends, ids.values, mask=texts.is_null())

    def _cut(self, text: str) -> list[str]:
        """Stretches of a text that no piece reaches across: spaces, then what is none."""
        if not text:
            return []
        if self.model.dummy_prefix:
            text = SPACE + text
        if "  " in text or "\0" in text or text[0] != " ":
            return _RUNS.findall(text)
        return text.replace(" ", "\0 ").split("\0")[1:]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids."""
        ids = pa.array(ids, pa.int32())
        return self.decode_column(pa.ListArray.from_arrays([0, len(ids)], ids))[0].as_py()

    def decode_column(self, ids: pa.ListArray) -> pa.Array:
        """The texts of a column of ids."""
        if not len(ids.values):
            return pc.if_else(ids.is_valid(), "", None).cast(pa.large_string())
        spelled = self.spelled.take(ids.values)
        _, ends, data = spelled.buffers()
        ends = np.frombuffer(ends, np.int64)[ids.offsets.to_numpy()]
        if self.model.dummy_prefix:
            letters = np.frombuffer(data, np.uint8)
            full = np.flatnonzero(ends[1:] > ends[:-1])
            spaced = full[letters[ends[full]] == ord(SPACE)]
            data = pa.py_buffer(np.delete(letters, ends[spaced]))
            ends[1:] -= np.cumsum(np.bincount(spaced, minlength=len(ids)))
        none = ids.is_null().to_numpy(zero_copy_only=False)
        valid = pa.py_buffer(np.packbits(~none, bitorder="little"))
        data = pa.Array.from_buffers(spelled.type, len(ids), [valid, pa.py_buffer(ends), data])
        try:
            return data.cast(pa.large_string())
        except pa.ArrowInvalid:
            texts = [d if d is None else d.decode("utf-8", "replace") for d in data.to_pylist()]
            return pa.array(texts, pa.large_string())


def _units_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Cut texts that are not empty before each space that follows another character.

    Returns the place of each text's first unit, with the end, and the units.
    """
    if not len(texts):
        return np.zeros(1, np.int64), texts
    _, ends, data = texts.buffers()
    ends = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    space = np.frombuffer(data, np.uint8)[: ends[-1]] == ord(SPACE)
    begins = space.copy()
    begins[1:] &= ~space[:-1]
    begins[: ends[0]] = False
    begins[ends[:-1]] = True
    cuts = np.append(np.flatnonzero(begins), ends[-1])
    units = pa.Array.from_buffers(texts.type, len(cuts) - 1, [None, pa.py_buffer(cuts), data])
    return np.searchsorted(cuts, ends), units


_RUNS = re.compile(r" +[^ ]*|[^ ]+")


class _Units(dict):
    """Ids of units as bytes of int32; holds a bounded number of short units."""

    def __init__(self, model: PieceModel) -> None:
        self.model = model
        self.search = WordSearch(model) if model.kind == "bpe" else None
        self.before: dict[str, bytes] = {}

    def of(self, units: list[str]) -> list[bytes]:
        """Ids of distinct units; the new short ones are searched all together.

        A full cache becomes the one before; what is met again moves over, the rest goes with
        the next change.
        """
        found = list(map(self.get, units))
        new = [unit for unit, ids in zip(units, found) if ids is None]
        if len(self) + len(new) >= _CACHED_UNITS:
            self.before = dict(self)
            self.clear()
        rest = self._together([unit for unit in new if not self._known(unit)])
        cut = {unit: self._parts(unit) for unit in rest}
        parts = {part for some in cut.values() if len(some) > 1 for part in some}.difference(self)
        parts = self._together([part for part in parts if not self._known(part)])
        parts += [unit for unit, some in cut.items() if len(some) == 1]
        short = {part for part in parts if len(part) <= _CACHED_LENGTH}
        self._one_after_the_other(sorted(short))
        for unit, some in cut.items():
            if len(some) > 1 and len(unit) <= _CACHED_LENGTH:
                self[unit] = b"".join(map(self.__getitem__, some))
        return [self[unit] if ids is None else ids for unit, ids in zip(units, found)]

    def _together(self, units: list[str]) -> list[str]:
        """Search the short units all together; returns those that remain."""
        if self.search is None:
            return units
        short = [unit for unit in units if len(unit) <= _CACHED_LENGTH]
        self.update(pair for pair in self.search.encode(short) if pair[1] is not None)
        return [unit for unit in units if unit not in self]

    def _one_after_the_other(self, parts: list[str]) -> None:
        """Search short parts in order; each goes on from the start it shares with the last."""
        search = None
        for part in parts:
            if search is None:
                search, shared = StreamingViterbi(self.model), 0
            else:
                shared = _shared(search.text, part)
                search.rewind(shared)
            settled = search.feed(part[shared:])
            self[part] = np.array(settled + search.rest(), np.int32).tobytes()
            if settled:
                search = None

    def _known(self, unit: str) -> bool:
        """Take a unit over from the cache before, if it is there."""
        if (data := self.before.get(unit)) is None:
            return False
        self[unit] = data
        return True

    def _parts(self, unit: str) -> list[str]:
        """Cut where no piece holds the two neighbouring characters; words need no look."""
        if unit[1:].isalpha():
            return [unit]
        joined, parts, start = self.model.joined, [], 0
        if unit[1:-1].isalpha():
            return [unit] if unit[-2:] in joined else [unit[:-1], unit[-1]]
        for at in range(1, len(unit)):
            if unit[at - 1 : at + 1] not in joined:
                parts.append(unit[start:at])
                start = at
        parts.append(unit[start:])
        return parts

    def __missing__(self, unit: str) -> bytes:
        if len(parts := self._parts(unit)) > 1:
            return b"".join(map(self.__getitem__, parts))
        search = StreamingViterbi(self.model)
        data = np.array(search.feed(unit) + search.rest(), np.int32).tobytes()
        if len(unit) <= _CACHED_LENGTH:
            self[unit] = data
        return data


def _shared(a: str, b: str) -> int:
    """Length of the common beginning."""
    for i, (x, y) in enumerate(zip(a, b)):
        if x != y:
            return i
    return min(len(a), len(b))


def encode_texts(text: Column, model: PieceModel) -> Column:
    """``array<int>`` of ids."""

    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = Encoder.of(model)
        for batch in batches:
            yield pd.Series(list(encoder.encode_all(batch)), dtype=object)

    return encode.asNondeterministic()(text)


def decode_ids(ids: Column, model: PieceModel) -> Column:
    """The text of an ``array<int>`` of ids."""

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = Encoder.of(model)
        for batch in batches:
            column = pa.array(batch, pa.list_(pa.int32()), from_pandas=True)
            yield pd.Series(encoder.decode_column(column).to_pylist(), dtype=object)

    return decode.asNondeterministic()(ids)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of a batch with about as many bytes of text as are searched at a time."""
    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy().astype(np.int64)
    part = (np.cumsum(sizes) - sizes) // _SLICE
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def tokenize(
    docs: DataFrame, model: PieceModel, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_tokens, ids, exact`` of every document.

    ``exact`` tells whether decoding the ids gives the text again, and is null for a null text.
    """

    def both_ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(model)
        for batch in batches:
            for some in _slices(batch):
                texts = some.column(1).cast(pa.large_string())
                ids = encoder.encode_column(texts)
                exact = pc.equal(encoder.decode_column(ids), texts)
                counts = pc.list_value_length(ids).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([some.column(0), counts, ids, exact], names)

    names = [id_col, "n_tokens", "ids", "exact"]
    kinds = [LongType(), ArrayType(IntegerType()), BooleanType()]
    schema = StructType([docs.schema[id_col]])
    for name, kind in zip(names[1:], kinds, strict=True):
        schema.add(name, kind)
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(both_ways, schema)
