"""Texts of an Arrow batch as one byte array, and hashes of their words and byte windows.

Everything is vectorised over a *slice* of texts of about ``SLICE_BYTES``, so
memory does not depend on the batch size; a longer text is a slice by itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
# For work that needs many arrays of a slice's size at once.
SMALL_SLICE_BYTES = 1 << 18

U64 = np.uint64
_MIX_1, _MIX_2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)
_ODD = U64(0x9E3779B97F4A7C15)


def utf8_slices(column: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, bytes, offsets)`` of consecutive rows; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if len(column) == 0:
        return
    _, at, data = column.buffers()
    ends = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if column.null_count:
        # Nulls may lie over bytes that are no text of theirs.
        sizes = np.where(column.is_null().to_numpy(zero_copy_only=False), 0, np.diff(ends))
        if int(sizes.sum()) != int(ends[-1] - ends[0]):
            column = column.fill_null(b"")
            yield from utf8_slices(column, limit)
            return
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + limit, side="right")) - 1)
        last = min(last, len(column))
        yield first, data[ends[first] : ends[last]], ends[first : last + 1] - ends[first]
        first = last


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = (h ^ (h >> U64(30))) * _MIX_1
    h = (h ^ (h >> U64(27))) * _MIX_2
    return h ^ (h >> U64(31))


def seeded(n: int, seed: int) -> np.ndarray:
    """``n`` fixed 64-bit numbers."""
    return mixed((np.arange(1, n + 1, dtype=U64) + U64(seed * 1_000_003)) * _ODD)


# Runs with more numbers of 64 bits than this are hashed one by one.
LONGEST_RUN = 32


def byte_run_hashes(data: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each run ``[begin, stop)``."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    # The eight bytes from each place on, as one number.
    blocks = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    return _run_hashes(blocks, 8, 8, begin, stop, lambda a, b: data[a:b].tobytes())


def code_run_hashes(codes: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A hash of the code points of each run ``[begin, stop)``."""
    codes = codes.astype(U64, copy=False)
    blocks = codes.copy()
    blocks[:-1] |= codes[1:] << U64(21)
    blocks[:-2] |= codes[2:] << U64(42)
    return _run_hashes(blocks, 3, 21, begin, stop, lambda a, b: codes[a:b].astype("<u4").tobytes())


def _run_hashes(blocks: np.ndarray, size: int, bits: int, begin: np.ndarray, stop: np.ndarray, whole) -> np.ndarray:
    """Mix the numbers of each run one after another; ``size`` elements of ``bits`` bits are a number.

    Each step is one-to-one in the number it takes in, and nothing of the sums
    and powers by which rolling hashes fall for regular words. A long run has the
    digest of its bytes.
    """
    masks = np.array([(1 << (bits * n)) - 1 for n in range(size)] + [(1 << 64) - 1], U64)
    h = mixed((stop - begin).astype(U64) * _ODD + _MIX_1)
    long = np.flatnonzero(stop - begin > LONGEST_RUN * size)
    active = np.flatnonzero(stop - begin <= LONGEST_RUN * size) if len(long) else np.arange(len(begin))
    at, left = begin[active], (stop - begin)[active]
    some = left > 0
    active, at, left = active[some], at[some], left[some]
    while len(active):
        h[active] = mixed(h[active] ^ (blocks[at] & masks[np.minimum(left, size)])) + _ODD
        more = left > size
        active, at, left = active[more], at[more] + size, left[more] - size
    for i in long.tolist():
        h[i] = int.from_bytes(hashlib.blake2b(whole(begin[i], stop[i]), digest_size=8).digest(), "little")
    return h


@lru_cache(maxsize=1)
def _byte_values() -> tuple[np.ndarray, np.ndarray]:
    """Each byte with A-Z as a-z, and which bytes separate words."""
    values = np.arange(256, dtype=np.uint8)
    values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    separates = np.zeros(256, bool)
    separates[[0x20, *range(0x09, 0x0E)]] = True
    return values, separates


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and where each text's words begin (and the last end).

    Words are the runs of bytes other than space, tab and line breaks; A-Z count as a-z.
    """
    values, separates = _byte_values()
    n = len(data)
    if n == 0:
        return np.zeros(0, U64), np.zeros(len(offsets), np.int64)
    inside = ~separates[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    starts_of_texts = offsets[:-1][offsets[:-1] < n]
    begins[starts_of_texts] = inside[starts_of_texts]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    ends_of_texts = offsets[1:][offsets[1:] > 0] - 1
    stops[ends_of_texts] = inside[ends_of_texts]
    begin, stop = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return byte_run_hashes(values[data], begin, stop), np.searchsorted(begin, offsets)


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words of each text, and where each text's begin.

    A text of fewer words has its whole sequence as its only shingle; one without words has none.
    """
    counts = np.diff(bounds)
    n_shingles = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    out_bounds = np.concatenate([[0], np.cumsum(n_shingles)])
    text = np.repeat(np.arange(len(counts)), n_shingles)
    first = bounds[:-1][text] + (np.arange(out_bounds[-1]) - out_bounds[:-1][text])
    length = np.minimum(counts, width)[text]
    h = np.zeros(len(first), U64)
    for i in range(width):
        here = length > i
        if here.all():
            h = h * _ODD + words[first + i]
        else:
            h[here] = h[here] * _ODD + words[first[here] + i]
    return mixed(h + length.astype(U64)), out_bounds


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` bytes (a power of two) from each place on; the last places have none."""
    h = seeded(256, 23)[data]
    done, factor = 1, int(_ODD) | 1
    while done < size:
        h = h[:-done] * U64(factor) + h[done:]
        factor = factor * factor % (1 << 64)
        done *= 2
    return mixed(h)


@lru_cache(maxsize=1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """Which code points are letters, and a number per code point with upper case as lower case."""
    letter = np.zeros(0x110000, bool)
    lower = np.arange(0x110000, dtype=np.uint32)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            letter[code] = True
            small = char.lower()
            if len(small) == 1:
                lower[code] = ord(small)
    return letter, lower


def letter_runs(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The words of all texts as runs of letters, by code point.

    ``chars`` (lower case; 0 where there is no letter), ``begin`` and ``stop``
    of every word, ``words`` and ``places``: where each text's words and code
    points begin (and the last end).
    """
    letter, lower = _letters()
    codes = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    places = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    inside = letter[codes]
    chars = np.where(inside, lower[codes], 0).astype(np.uint64)
    edge = np.zeros(len(codes) + 1, bool)
    edge[places] = True
    before, after = np.zeros(len(codes), bool), np.zeros(len(codes), bool)
    before[1:] = inside[:-1]
    after[:-1] = inside[1:]
    begin = np.flatnonzero(inside & (~before | edge[:-1]))
    stop = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return {"chars": chars, "begin": begin, "stop": stop, "words": np.searchsorted(begin, places), "places": places}


def letter_word_hashes(runs: dict[str, np.ndarray]) -> np.ndarray:
    """A hash per word of :func:`letter_runs`."""
    return code_run_hashes(runs["chars"], runs["begin"], runs["stop"])
