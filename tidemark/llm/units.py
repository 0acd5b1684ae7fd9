"""Array helpers that run inside tasks: words of many texts at once, and ids of words that repeat.

Texts are taken in slices of a few MB, so the memory of a task does not depend on the size of a batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyarrow import compute as pc

SLICE_BYTES = 2 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# One random number per byte value; words are summed up with powers of an odd number, then mixed.
_BYTE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of a word that are summed up at once. In 64 bits such sums agree for words as short as 1,024 bytes, whatever the
#: step (Thue-Morse words), so longer words are mixed piece by piece.
PIECE_BYTES = 64


def slices(texts: list[str | None], limit: int = SLICE_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first, UTF-8 texts) of runs of at most about ``limit`` bytes; nulls are empty."""
    start, size, run = 0, 0, []
    for i, text in enumerate(texts):
        raw = text.encode("utf-8") if text else b""
        if run and size + len(raw) > limit:
            yield start, run
            start, size, run = i, 0, []
        run.append(raw)
        size += len(raw)
    if run:
        yield start, run


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """Words (runs of bytes that are not white space) of several texts: hash, text number, and per-text figures."""

    def __init__(self, texts: list[bytes], lower: bool = False):
        self.n_texts = len(texts)
        self.buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        if lower:
            self.buf = _LOWER[self.buf]
        lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        self.text_start = np.concatenate([[0], np.cumsum(lengths)])[:-1]
        self.inside = ~_SPACE[self.buf]
        edge = np.diff(np.concatenate([[False], self.inside, [False]]).astype(np.int8))
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.text = np.searchsorted(self.text_start, self.start, "right") - 1
        self.count = np.bincount(self.text, minlength=self.n_texts)

    def hashes(self) -> np.ndarray:
        """One 64-bit value per word."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        length = self.end - self.start
        pieces = -(-length // PIECE_BYTES)
        first = np.cumsum(pieces) - pieces
        nth = np.arange(int(pieces.sum())) - np.repeat(first, pieces)
        size = np.minimum(np.repeat(length, pieces) - nth * PIECE_BYTES, PIECE_BYTES)
        begin = np.cumsum(size) - size
        place = np.arange(int(size.sum())) - np.repeat(begin, size)
        power = np.cumprod(np.full(int(size.max()), _STEP, np.uint64))
        part = np.add.reduceat(_BYTE[self.buf[self.inside]] * power[place], begin)
        part = mix64(part + np.repeat(length, pieces).astype(np.uint64))
        later = nth > 0
        part[later] = mix64(part[later] + nth[later].astype(np.uint64) * _STEP)
        return np.add.reduceat(part, first)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, index of the first word) of all runs of ``n`` words inside one text."""
        h = self.hashes()
        m = len(h) - n + 1
        if m <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        first = np.flatnonzero(self.text[:m] == self.text[n - 1 :])
        total = np.zeros(len(first), np.uint64)
        for j in range(n):
            total = mix64(total + h[first + j] * np.uint64(2 * j + 3))
        return total, first

    def per_text(self, bytes_: np.ndarray) -> np.ndarray:
        """How many marked bytes every text has."""
        return np.add.reduceat(bytes_.astype(np.int64), self.text_start)


class IdPool:
    """Ids of units (words) seen so far. Units repeat a lot, so only new ones are encoded, all of a slice at once.

    ``encode`` returns all ids of a list of units and the number of ids of each.

    The pool starts anew when it holds ``limit`` ids; long units are never kept. This changes speed, not results.
    """

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int = 3_000_000, longest: int = 48):
        self.encode, self.limit, self.longest = encode, limit, longest
        self.clear()

    def clear(self) -> None:
        self.at: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, np.int32)
        self.start = np.zeros(1 << 14, np.int64)
        self.length = np.zeros(1 << 14, np.int64)
        self.used = self.units = 0

    def _add(self, new: list[str]) -> int:
        """Append the ids of new units; returns the number of the first one."""
        flat, length = self.encode(new)
        if self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.used], np.zeros(self.used + 2 * len(flat), np.int32)])
        if self.units + len(new) > len(self.start):
            room = np.zeros(self.units + 2 * len(new), np.int64)
            self.start = np.concatenate([self.start[: self.units], room])
            self.length = np.concatenate([self.length[: self.units], room])
        first = self.units
        self.ids[self.used : self.used + len(flat)] = flat
        self.start[first : first + len(new)] = self.used + np.cumsum(length) - length
        self.length[first : first + len(new)] = length
        self.used += len(flat)
        self.units += len(new)
        return first

    def numbers(self, units: list[str]) -> np.ndarray:
        """The number of every unit; units not seen are encoded first. Numbers hold until ``clear``."""
        number = np.fromiter(map(self.at.get, units, repeat(-1)), np.int64, len(units))
        missing = np.flatnonzero(number < 0)
        if len(missing):
            unseen = [units[i] for i in missing.tolist()]
            new = list(dict.fromkeys(unseen))
            first = self._add(new)
            self.at.update(zip(new, range(first, first + len(new))))
            if len(new) == len(unseen):
                number[missing] = np.arange(first, first + len(new))
            else:
                number[missing] = np.fromiter(map(self.at.__getitem__, unseen), np.int64, len(missing))
            for u in [u for u in new if len(u) > self.longest]:
                del self.at[u]
        return number

    def of_numbers(self, number: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, ids per text) of texts given as numbers of units, ``counts`` of them each."""
        length = self.length[number]
        total = int(length.sum())
        begin = np.cumsum(length) - length
        ids = self.ids[np.repeat(self.start[number] - begin, length) + np.arange(total)]
        upto = np.concatenate([[0], np.cumsum(length)])
        bound = np.concatenate([[0], np.cumsum(counts)])
        return ids, upto[bound[1:]] - upto[bound[:-1]]

    def __call__(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, ids per text) of texts given as lists of units."""
        if self.used > self.limit:
            self.clear()
        number = self.numbers([u for units in texts for u in units])
        return self.of_numbers(number, np.fromiter(map(len, texts), np.int64, len(texts)))

    def of_words(self, words: pa.Array, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same of texts given as one array of all their units: only the distinct ones are looked up."""
        coded = words.dictionary_encode()
        return self.of_coded(strings(coded.dictionary), coded.indices.to_numpy(zero_copy_only=False), counts)

    def of_coded(self, units: list[str], code: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same of texts given as places in a list of distinct units."""
        if self.used > self.limit:
            self.clear()
        return self.of_numbers(self.numbers(units)[code], counts)


def strings(array: pa.Array) -> list[str]:
    return array.to_numpy(zero_copy_only=False).tolist()


_PARTING = np.zeros(256, bool)
_PARTING[[9, 10, 13, 32]] = True


def parted(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(all words, words per text) of texts parted at blanks, tabs and line ends; nulls have no words."""
    whole = pc.fill_null(texts, "").cast(pa.large_string())
    whole = pa.ListArray.from_arrays(pa.array([0, len(whole)], pa.int32()), whole)
    data = pc.binary_join(whole, pa.scalar("\n", pa.large_string())).buffers()[2]
    letters = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    gap = _PARTING[letters]
    gaps = np.flatnonzero(gap)
    first, last = np.concatenate([[0], gaps + 1]), np.concatenate([gaps, [len(letters)]])
    full = last > first
    # Where words start once the gaps are gone.
    offsets = np.concatenate([(first - np.arange(len(first)))[full], [len(letters) - len(gaps)]])
    words = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(letters[~gap]))
    # The end of every text is a gap, or the end of all.
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.searchsorted(last, np.cumsum(sizes) + np.arange(len(texts)))
    return words, np.diff(np.concatenate([[0], np.cumsum(full)[ends]])) if len(texts) else np.zeros(0, np.int64)
