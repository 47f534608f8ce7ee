"""Words of many texts at once, as arrays.

A word is a run of bytes other than space and 0x09-0x0D, as in ``[^\\x20\\x09-\\x0D]+``, or
a run of another class of bytes. All
texts of an Arrow array are scanned in one pass over their bytes, so no Python runs for a
single word. Words and phrases are known by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of a hash over the whole word (the finaliser of splitmix64)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes; a longer text has a range of its own."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(False)
    start, held = 0, 0
    for row, size in enumerate(sizes.tolist()):
        if held and held + size > limit:
            yield start, row
            start, held = row, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def text_array(column: pa.Array) -> pa.Array:
    """A text column with 64-bit offsets and without nulls."""
    return pc.fill_null(column.cast(pa.large_string()), "")


def not_blank(data: np.ndarray) -> np.ndarray:
    return ~((data == 32) | ((data >= 9) & (data <= 13)))


def letters_and_digits(data: np.ndarray) -> np.ndarray:
    """Bytes of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``: 0-9, a-z and all beyond ASCII."""
    return ((data >= 48) & (data <= 57)) | ((data >= 97) & (data <= 122)) | (data >= 128)


def latin_letters(data: np.ndarray) -> np.ndarray:
    """Bytes of ``[A-Za-z\\u00C0-\\u00FF]``; the latter are 0xC3 and any byte after it."""
    inside = ((data >= 97) & (data <= 122)) | ((data >= 65) & (data <= 90)) | (data == 0xC3)
    inside[1:] |= data[:-1] == 0xC3
    return inside


class Words:
    """Words of some texts: byte ranges in ``data``, and the first word of each text."""

    def __init__(
        self,
        texts: pa.Array,
        lower: bool = False,
        inside_words: Callable[[np.ndarray], np.ndarray] = not_blank,
    ):
        """``texts``: large strings without nulls; ``lower`` folds A-Z only, before the rest."""
        offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
        low, high = int(offsets[0]), int(offsets[-1])
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8, high - low, low) if high > low else np.empty(0, np.uint8)
        bounds = offsets - low
        if lower:
            data = np.where((data >= 65) & (data <= 90), data | 32, data)
        inside = inside_words(data)
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        cuts = bounds[:-1][bounds[:-1] < len(data)]
        begins[cuts] = inside[cuts]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:]
        last = bounds[1:][bounds[1:] > 0] - 1
        ends[last] = inside[last]
        self.data = data
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.starts, bounds)  # words before each text
        self.counts = np.diff(self.first)
        self._inside = inside

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        if not len(self.starts):
            return np.empty(0, np.uint64)
        lengths = self.ends - self.starts
        at = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        offset = np.arange(int(lengths.sum())) - np.repeat(at, lengths)
        powers = np.full(int(lengths.max()), _BASE)
        powers[0] = 1
        powers = np.multiply.accumulate(powers)
        terms = (self.data[self._inside].astype(np.uint64) + np.uint64(1)) * powers[offset]
        return mix(np.add.reduceat(terms, at) + lengths.astype(np.uint64) * _STEP)

    def coded(self) -> tuple[list[bytes], np.ndarray]:
        """The distinct words, and the place of each word among them."""
        lengths = self.ends - self.starts
        offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int64)
        held = pa.Array.from_buffers(
            pa.large_binary(),
            len(lengths),
            [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(self.data[self._inside].tobytes())],
        ).dictionary_encode()
        return held.dictionary.to_pylist(), held.indices.to_numpy(False)

    def rows(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Number of ``size``-word windows of each text, and the first word of each window."""
        counts = np.maximum(self.counts - (size - 1), 0)
        total = int(counts.sum())
        before = np.concatenate(([0], np.cumsum(counts)[:-1])) if len(counts) else counts
        at = np.arange(total) + np.repeat(self.first[:-1] - before, counts)
        return counts, at


def phrase_hashes(words: np.ndarray, size: int, at: np.ndarray) -> np.ndarray:
    """Hash of the ``size`` words from each position of ``at``, in order."""
    total = np.zeros(len(at), np.uint64)
    for step in range(size):
        total = total * _STEP + words[at + step]
    return mix(total)

