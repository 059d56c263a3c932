"""Texts as pieces, and the token ids of pieces in ragged arrays.

A text is cut where a space follows one of the characters ! to ~ or À to ɏ: such a space always starts a new pre-token, and
so does the text after it, since a pre-token takes at most one space, in front, and never ends before one. A single line break
between two of them is a pre-token of its own. Arrow finds the distinct pieces of many texts at once; only those
meet Python, and only new ones a tokenizer library. The ids of whole texts are then gathered by offsets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of pieces and ids that a store remembers, and the longest piece it remembers at all.
MOST_BYTES, LONGEST = 256 << 20, 48
#: What Python needs for a remembered piece besides its characters and ids.
_ENTRY = 200


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, … of each run, one run after another."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sum of each of the consecutive runs; a run may be empty."""
    upto = np.append(0, np.cumsum(values))
    ends = np.cumsum(sizes)
    return upto[ends] - upto[ends - sizes]


class Ragged:
    """Rows of ids of different lengths in one array that grows."""

    def __init__(self, kind: np.dtype) -> None:
        self.flat, self.used = np.empty(1 << 12, dtype=kind), 0
        self.starts, self.sizes, self.rows = np.empty(1 << 10, np.int64), np.empty(1 << 10, np.int32), 0

    def add(self, sizes: np.ndarray, ids: np.ndarray) -> None:
        self.flat = self._room(self.flat, self.used, len(ids))
        self.starts = self._room(self.starts, self.rows, len(sizes))
        self.sizes = self._room(self.sizes, self.rows, len(sizes))
        new = slice(self.rows, self.rows + len(sizes))
        self.flat[self.used : self.used + len(ids)] = ids
        self.starts[new], self.sizes[new] = self.used + np.cumsum(sizes) - sizes, sizes
        self.used, self.rows = self.used + len(ids), self.rows + len(sizes)

    @staticmethod
    def _room(array: np.ndarray, used: int, more: int) -> np.ndarray:
        if used + more <= len(array):
            return array
        larger = np.empty(max(used + more, 2 * len(array)), dtype=array.dtype)
        larger[:used] = array[:used]
        return larger

    def cut(self, rows: int) -> None:
        """Forget all but the first ``rows`` rows, and the room they took."""
        self.used = int(self.starts[rows]) if rows < self.rows else self.used
        self.rows = rows
        if len(self.flat) > 4 * max(self.used, 1 << 12):
            self.flat = self.flat[: 2 * max(self.used, 1 << 11)].copy()

    def row(self, i: int) -> np.ndarray:
        return self.flat[self.starts[i] : self.starts[i] + self.sizes[i]]

    def gather(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the rows, one row after another, and how many each has."""
        sizes = self.sizes[rows].astype(np.int64)
        return self.flat[ragged(self.starts[rows], sizes)], sizes


class PieceIds:
    """What ``learn`` says of pieces: one list of ids a piece in each of some fields.

    Short pieces are remembered until together they take ``most_bytes``, then all are forgotten; long ones only
    until the next call. So memory is bounded by the texts of one call and ``most_bytes``.
    """

    def __init__(
        self,
        learn: Callable[[Sequence[str]], Iterable[tuple[Sequence[int], ...]]],
        kinds: Sequence[np.dtype],
        most_bytes: int = MOST_BYTES,
        longest: int = LONGEST,
    ) -> None:
        self.learn, self.kinds, self.most_bytes, self.longest = learn, kinds, most_bytes, longest
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.fields = [Ragged(kind) for kind in self.kinds]
        self.bytes = self.kept = 0

    def rows(self, pieces: Sequence[str]) -> np.ndarray:
        """The row of each piece (distinct) in all ``fields``, until the next call."""
        for field in self.fields:
            field.cut(self.kept)
        if self.bytes > self.most_bytes:
            self._forget()
        found = np.fromiter(map(self.known.get, pieces, repeat(-1)), np.int64, count=len(pieces))
        new = np.flatnonzero(found < 0).tolist()
        short = [i for i in new if len(pieces[i]) <= self.longest]
        self._add(pieces, short, found)
        self.known.update(zip([pieces[i] for i in short], found[short].tolist(), strict=True))
        self.kept = self.fields[0].rows
        self.bytes = len(self.known) * _ENTRY + sum(f.used * f.flat.itemsize for f in self.fields)
        if len(short) < len(new):
            self._add(pieces, [i for i in new if len(pieces[i]) > self.longest], found)
        return found

    def _add(self, pieces: Sequence[str], which: list[int], found: np.ndarray) -> None:
        found[which] = np.arange(len(which)) + self.fields[0].rows
        columns = zip(*self.learn([pieces[i] for i in which]), strict=True) if which else ()
        for field, column in zip(self.fields, columns, strict=False):
            sizes = np.fromiter(map(len, column), np.int64, count=len(column))
            field.add(sizes, np.fromiter(chain.from_iterable(column), field.flat.dtype, count=int(sizes.sum())))


def cut_texts(texts: pa.StringArray, lines: bool) -> tuple[pa.StringArray, np.ndarray]:
    """The pieces of all texts, one text after another, without copying them, and how many each text has.

    A piece begins with the space it was cut before; with ``lines`` also with a single line break. No text may be null.
    """
    texts = texts.cast(pa.string())
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int32)
    first, last = int(offsets[0]), int(offsets[-1])
    if first == last:
        return pa.array([], pa.string()), np.zeros(len(texts), np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)
    starts = np.zeros(last - first, bool)
    places = np.flatnonzero(data[first + 1 : last] == 0x20) + first + 1
    starts[places[ends_surely(data, places)] - first] = True
    if lines:
        places = np.flatnonzero(data[first + 1 : last - 1] == 0x0A) + first + 1
        after = data[places + 1]
        places = places[ends_surely(data, places) & (((after > 0x20) & (after < 0x7F)) | ((after >= 0xC3) & (after <= 0xC8)))]
        starts[places - first] = True
    # A text's first piece begins with the text.
    starts[offsets[:-1][offsets[:-1] < offsets[1:]] - first] = True
    at = np.append(np.flatnonzero(starts) + first, last).astype(np.int32)
    pieces = pa.StringArray.from_buffers(len(at) - 1, pa.py_buffer(at), texts.buffers()[2])
    return pieces, np.diff(np.searchsorted(at[:-1], offsets))


def ends_surely(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Whether the character before each place lets a text be cut: an ASCII sign or letter, or one of À to ɏ (two bytes)."""
    before, lead = data[places - 1], data[np.maximum(places - 2, 0)]
    latin = (before >= 0x80) & (((lead >= 0xC3) & (lead <= 0xC8)) | ((lead == 0xC9) & (before <= 0x8F)))
    return ((before > 0x20) & (before < 0x7F)) | latin


def piece_rows(texts: pa.StringArray, store: PieceIds, lines: bool) -> tuple[np.ndarray, np.ndarray]:
    """Row in ``store`` of each piece of the texts, and the pieces of each text."""
    pieces, sizes = cut_texts(texts, lines)
    if not len(pieces):
        return np.empty(0, np.int64), sizes
    coded = pieces.dictionary_encode()
    return store.rows(coded.dictionary.to_pylist())[coded.indices.to_numpy()], sizes


def runs(texts: pa.StringArray, most: int) -> Iterator[tuple[pa.StringArray, int, int]]:
    """The texts in runs of about ``most`` bytes, or one text that is longer: run, first and last row + 1."""
    upto = np.cumsum(pc.binary_length(texts).to_numpy().astype(np.int64))
    start, before = 0, 0
    while start < len(texts):
        end = max(start + 1, int(np.searchsorted(upto, before + most, side="right")))
        yield texts.slice(start, end - start), start, end
        start, before = end, int(upto[end - 1])
