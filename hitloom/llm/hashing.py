"""Words and character n-grams of many texts at once, as 64-bit hashes in numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_random = np.random.default_rng(20240607)
_BYTE = _random.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_BLANK = np.zeros(256, bool)
_IS_BLANK[[9, 10, 11, 12, 13, 32]] = True
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row, and where each begins and the last one ends."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array, most_bytes: int = 8 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows with about ``most_bytes`` of text: first row, end row, bytes, offsets."""
    data, offsets = text_bytes(column)
    n, first = len(offsets) - 1, 0
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + most_bytes, "right")) - 1
        end = min(max(end, first + 1), n)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def separated(data: np.ndarray, offsets: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Texts with white space as blanks and one blank before each and after the last; their starts."""
    n = len(offsets) - 1
    out = np.full(len(data) + n + 1, 32, np.uint8)
    place = np.arange(len(data)) + np.repeat(np.arange(1, n + 1), np.diff(offsets))
    clean = _LOWER[data] if lower else data.copy()
    clean[_IS_BLANK[data]] = 32
    out[place] = clean
    return out, offsets + np.arange(n + 1)


def word_spans(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in blank-separated bytes that begin and end with a blank."""
    edge = np.diff((text != 32).astype(np.int8))
    return np.flatnonzero(edge == 1) + 1, np.flatnonzero(edge == -1) + 1


_UNSTEP = np.uint64(pow(int(_STEP), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    powers = np.full(n, base, np.uint64)
    powers[:1] = 1
    return np.multiply.accumulate(powers)


def prefix_sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sums of bytes weighted by powers of a step, and the inverse powers."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _powers(_STEP, len(data)), out=sums[1:])
    return sums, _powers(_UNSTEP, len(data) + 1)


def ranges_hash(sums: np.ndarray, inverse: np.ndarray, starts: np.ndarray, sizes: np.ndarray | int) -> np.ndarray:
    """Hashes of ranges of bytes; the inverse power of their start makes equal ranges equal anywhere."""
    return mix((sums[starts + sizes] - sums[starts]) * inverse[starts] ^ np.asarray(sizes).astype(np.uint64))


def word_hashes(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash per word."""
    if not len(starts):
        return np.empty(0, np.uint64)
    return ranges_hash(*prefix_sums(text), starts, ends - starts)


def char_ngrams(text: np.ndarray, sizes: range) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per size: the starts of all n-grams without a blank inside (but perhaps at an end), and their hashes."""
    coded = _BYTE[text]
    blanks = np.cumsum(text == 32)
    rolling = coded
    for size in range(2, sizes.stop):
        if len(text) < size:
            return
        rolling = rolling[: len(text) - size + 1] * _STEP + coded[size - 1 :]
        if size in sizes:
            inside = blanks[size - 2 : len(text) - 1] - blanks[: len(text) - size + 1] if size > 2 else None
            good = inside == 0 if size > 2 else np.ones(len(rolling), bool)
            starts = np.flatnonzero(good)
            yield size, starts, mix(rolling[starts] + np.uint64(size))
