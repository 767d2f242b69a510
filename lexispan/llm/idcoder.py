"""A context-mixing range coder for token ids, in independent, checksummed blocks.

A block's ids are numbered by the list of those it uses and cut into up to
``LANES`` runs that are coded side by side, one id of each run per step, with
one model that is reset for every block:

* Order 2 and order 1: the id that last followed the two ids (the one id)
  before, with a count of how often it was right. "Is it the order-2 guess",
  then "is it the order-1 guess", are binary decisions; their probabilities
  come from two adaptive contexts each, mixed in the logistic domain with
  weights that learn from their errors.
* Order 0: what neither guess hits is coded by adaptive frequencies.

Both decisions depend on nothing but the two counts and whether the guesses
agree: 512 cases. Probabilities, intervals and what is learned are worked out
once per case, not per lane, and after the first steps at every fourth only.
Weights follow the mean error, so that more lanes do not make them swing. All
arithmetic is on integers, so decoding repeats encoding exactly, and every step
is vectorised over the lanes.
"""

from __future__ import annotations

import math
import struct
import zlib
from functools import lru_cache

import numpy as np

MAGIC = b"LXT2"
LANES = 4096
LEAST_PER_LANE = 128

HASH_BITS = 16
# Decisions learn at each of the first steps, then every so many.
LEARN_AT_ONCE, LEARN_EVERY = 16, 4
# The higher, the less a mean error changes the weights.
MIX_SLOWLY = 16

SURE_BITS = 4
MOST_SURE = (1 << SURE_BITS) - 1
CASE_BITS = 16
FREQUENCY_BITS = 20
LARGEST_ID = (1 << 18) - 1

U64 = np.uint64
# A decision and a symbol together narrow a range by at most 36 bits, less than BOTTOM has.
TOP, BOTTOM = U64(1 << 48), U64(1 << 44)
WORD = U64(16)

# The cases of a step: the counts of both guesses, and whether the guesses agree.
_CASES = np.arange(1 << (2 * SURE_BITS + 1))
_SURE2, _SURE1, _AGREE = _CASES >> (SURE_BITS + 1), (_CASES >> 1) & MOST_SURE, _CASES & 1


def _next_entries(sure: np.ndarray, hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By four times the case plus what was hit: what is added to a guess with its count, and whether a new guess takes its place."""
    sure = np.repeat(sure, 4)
    hit = np.tile(hit, len(_CASES))
    change = np.where(hit, sure < MOST_SURE, (sure >> 1) - sure)
    return change.astype(np.int32), ~hit & (sure <= 1)


# What was hit: 2 for the order-2 guess, plus 1 for the order-1 guess.
_CHANGE2, _REPLACE2 = _next_entries(_SURE2, np.arange(4) >= 2)
_CHANGE1, _REPLACE1 = _next_entries(_SURE1, np.arange(4) % 2 == 1)


class CorruptBlock(ValueError):
    """The bytes of a block are not those that were written."""


@lru_cache(maxsize=1)
def _logistic() -> tuple[np.ndarray, np.ndarray]:
    """``stretch`` of a 12-bit probability, in 1/256, and ``squash``, its inverse over -2047 .. 2047."""
    stretch = np.array([round(256 * math.log((p + 0.5) / (4095.5 - p))) for p in range(4096)], np.int64)
    squash = np.array([min(4095, max(1, round(4096 / (1 + math.exp(-x / 256))))) for x in range(-2047, 2048)], np.int64)
    return stretch, squash


# A decision's contexts by case, one number range after the other: first and second of "order 2", then of "order 1".
_COUNTS = MOST_SURE + 1
_CONTEXTS = np.array([[_SURE2, 3 * _COUNTS + _SURE1], [_COUNTS + 2 * _SURE1 + _AGREE, 4 * _COUNTS + _SURE2]])
# Which weights mix them.
_WEIGHTS = np.array([_AGREE, np.full_like(_AGREE, 2)])


def _sums(of: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of whole numbers (below 2**53) by the group ``of`` each."""
    return np.bincount(of.ravel(), weights=values.ravel(), minlength=n).astype(np.int64)


class _Decisions:
    """Probabilities, for every case, that either guess is right: two adaptive contexts each, and a mixer."""

    def __init__(self) -> None:
        self.table = np.full(5 * _COUNTS, 1 << 14, np.int64)
        self.weights = np.full((2, 3), 1 << 15, np.int64)
        self.stretch, self.squash = _logistic()

    def probabilities(self) -> np.ndarray:
        self.inputs = self.stretch[self.table >> 4][_CONTEXTS]
        mix = (self.weights[0][_WEIGHTS] * self.inputs[0] + self.weights[1][_WEIGHTS] * self.inputs[1]) >> 16
        self.p = self.squash[np.minimum(np.maximum(mix, -2047), 2047) + 2047]
        return self.p

    def learn(self, asked: np.ndarray, right: np.ndarray) -> None:
        """How often each decision was asked in each case, and how often its guess was right."""
        n = _sums(_CONTEXTS, np.stack([asked, asked]), len(self.table))
        hits = _sums(_CONTEXTS, np.stack([right, right]), len(self.table))
        self.table += (hits * 65535 - n * self.table) // (n + 30)
        error = (right << 12) - asked * self.p
        n = _sums(_WEIGHTS, asked, self.weights.shape[1])
        for weights, x in zip(self.weights, self.inputs):
            weights += _sums(_WEIGHTS, error * x, len(weights)) // (MIX_SLOWLY * (n + 30))
        np.minimum(np.maximum(self.weights, -(1 << 18)), 1 << 18, out=self.weights)


class _Model:
    def __init__(self, vocabulary: int) -> None:
        self.n = vocabulary
        # Guess and count in one number.
        self.last2, self.last1 = np.zeros(1 << HASH_BITS, np.int32), np.zeros(vocabulary + 1, np.int32)
        self.decisions = _Decisions()
        self.counts = np.zeros(vocabulary, np.int64)
        self.recent: list[np.ndarray] = []
        self.happened = np.zeros((len(_CASES), 4), np.int64)
        self.steps, self.next_build = 0, 1
        self._build()
        self._intervals()

    def _build(self) -> None:
        spare = (1 << FREQUENCY_BITS) - self.n
        total = int(self.counts.sum())
        frequency = np.ones(self.n, np.int64)
        if total:
            frequency += self.counts * spare // total
        frequency[0] += (1 << FREQUENCY_BITS) - int(frequency.sum())
        below = np.cumsum(frequency) - frequency
        self.frequency, self.inverse = frequency, None
        # Start and width; the number after the last stands for "no symbol" and takes the whole.
        self.symbols = np.append(below << (FREQUENCY_BITS + 1) | frequency, 1 << FREQUENCY_BITS).astype(U64)

    def at(self, place: np.ndarray) -> np.ndarray:
        """The symbols whose intervals hold these places."""
        if self.inverse is None:
            self.inverse = np.repeat(np.arange(self.n, dtype=np.int32), self.frequency)
        return self.inverse[place]

    def guesses(self, before2: np.ndarray, before1: np.ndarray) -> None:
        mixed = before2 * 0x9E3779B1
        mixed += before1 * 0x85EBCA6B
        mixed >>= 7
        mixed &= (1 << HASH_BITS) - 1
        self.at2, self.at1 = mixed, before1
        self.entry2, self.entry1 = self.last2.take(mixed), self.last1.take(before1)
        self.g2, self.g1 = self.entry2 >> SURE_BITS, self.entry1 >> SURE_BITS
        case = (self.entry2 & MOST_SURE) << (SURE_BITS + 1)
        case |= (self.entry1 & MOST_SURE) << 1
        case |= self.g2 == self.g1
        self.case = case.astype(np.int64)

    def _intervals(self) -> None:
        """Start and width of "neither", "order 1", "order 2" and "both" within 2**16, for every case."""
        p2, p1 = self.decisions.probabilities()
        wide2 = p2 << (CASE_BITS - 12)
        left = (1 << CASE_BITS) - wide2
        wide1 = np.maximum((left * p1) >> 12, 1) * (1 - _AGREE)
        table = np.empty((len(_CASES), 4), np.int64)
        table[:, 0] = (wide2 + wide1) << (CASE_BITS + 1) | (left - wide1)
        table[:, 1] = wide2 << (CASE_BITS + 1) | wide1
        table[:, 2] = table[:, 3] = wide2
        self.outcomes = table.astype(U64).ravel()

    def outcome(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Four times the case plus what the ids hit, and the symbols to code."""
        what = self.case << 2
        what |= (ids == self.g2).astype(np.int64) << 1
        what |= ids == self.g1
        return what, np.where(what & 3, self.n, ids)

    def learn(self, ids: np.ndarray, what: np.ndarray, symbols: np.ndarray) -> None:
        self.happened += np.bincount(what, minlength=4 * len(_CASES)).reshape(-1, 4)
        if self.steps < LEARN_AT_ONCE or self.steps % LEARN_EVERY == 0:
            n = self.happened
            hits2, missed2 = n[:, 2] + n[:, 3], n[:, 0] + n[:, 1]
            self.decisions.learn(np.stack([hits2 + missed2, missed2 * (1 - _AGREE)]), np.stack([hits2, n[:, 1]]))
            self._intervals()
            n[:] = 0
        new = (ids << SURE_BITS | 1).astype(np.int32)
        self.last2[self.at2] = np.where(_REPLACE2.take(what), new, self.entry2 + _CHANGE2.take(what))
        self.last1[self.at1] = np.where(_REPLACE1.take(what), new, self.entry1 + _CHANGE1.take(what))
        self.recent.append(symbols)
        self.steps += 1
        if self.steps == self.next_build:
            self.counts += np.bincount(np.concatenate(self.recent), minlength=self.n + 1)[: self.n]
            self.recent = []
            self.next_build += min(self.steps, 16)
            self._build()


class _Coder:
    """Ranges of all lanes, and how they shrink; what becomes of settled bits is the encoder's or decoder's part."""

    def __init__(self, lanes: int) -> None:
        self.low, self.range = np.zeros(lanes, U64), np.full(lanes, (1 << 64) - 1, U64)

    def narrow(self, intervals: np.ndarray, bits: int) -> None:
        """New ranges of the first lanes, by start and width within ``2**bits``."""
        low, range_ = self.low[: len(intervals)], self.range[: len(intervals)]
        unit = range_ >> U64(bits)
        low += (intervals >> U64(bits + 1)) * unit
        np.multiply(intervals & U64((2 << bits) - 1), unit, out=range_)

    def settle(self, active: int) -> None:
        """Puts out the leading bits that are settled; every range is then at least ``BOTTOM``."""
        at = None
        low, range_ = self.low[:active], self.range[:active]
        while True:
            settled = (low ^ (low + range_)) < TOP
            short = range_ < BOTTOM
            short &= ~settled
            if short.any():
                range_[short] = (~low[short] + U64(1)) & (BOTTOM - U64(1))
                settled |= short
            out = np.flatnonzero(settled)
            # Those lanes that put nothing out this time are done.
            if at is not None:
                self.low[at], self.range[at] = low, range_
            if not len(out):
                return
            at = out if at is None else at[out]
            low, range_ = low[out], range_[out]
            self.shift(at, low)
            low <<= WORD
            range_ <<= WORD


class _Encoder(_Coder):
    def __init__(self, lanes: int) -> None:
        super().__init__(lanes)
        self.lanes: list[np.ndarray] = []
        self.words: list[np.ndarray] = []

    def shift(self, at: np.ndarray, low: np.ndarray) -> None:
        self.lanes.append(at.astype(np.uint16))
        self.words.append((low >> U64(48)).astype(np.uint16))

    def streams(self) -> tuple[np.ndarray, np.ndarray]:
        # Two words lead into a range of BOTTOM or more, whatever follows them.
        last = self.low + U64((1 << 32) - 1)
        every = np.arange(len(last))
        self.shift(every, last)
        self.shift(every, last << WORD)
        lanes, words = np.concatenate(self.lanes), np.concatenate(self.words)
        return np.bincount(lanes, minlength=len(every)).astype("<u4"), words[np.argsort(lanes, kind="stable")].astype("<u2")


class _Decoder(_Coder):
    def __init__(self, sizes: np.ndarray, words: np.ndarray) -> None:
        super().__init__(len(sizes))
        self.words = np.concatenate([words, np.zeros(8, words.dtype)])
        self.next = np.concatenate([[0], np.cumsum(sizes.astype(np.int64))])[:-1]
        self.code = np.zeros(len(sizes), U64)
        for _ in range(4):
            self.shift(np.arange(len(sizes)), None)

    def shift(self, at: np.ndarray, _low) -> None:
        place = self.next[at]
        self.code[at] = (self.code[at] << WORD) | self.words.take(place, mode="clip")
        self.next[at] = place + 1

    def ids(self, model: _Model) -> np.ndarray:
        """The next id of each of the first lanes."""
        case = model.case << 2
        unit = self.range[: len(case)] >> U64(CASE_BITS)
        inside = self.code[: len(case)] - self.low[: len(case)]
        neither = model.outcomes.take(case)
        start = (neither >> U64(CASE_BITS + 1)) * unit
        found = np.where(inside < model.outcomes.take(case + 2) * unit, model.g2, model.g1).astype(np.int64)
        rest = np.flatnonzero(inside >= start)
        if len(rest):
            width = (neither[rest] & U64((2 << CASE_BITS) - 1)) * unit[rest]
            value = (inside[rest] - start[rest]) // (width >> U64(FREQUENCY_BITS))
            found[rest] = model.at(np.minimum(value, U64((1 << FREQUENCY_BITS) - 1)).astype(np.int64))
        return found


def _code(coder: _Encoder | _Decoder, model: _Model, n: int, lanes: int, grid: np.ndarray | None) -> np.ndarray:
    """Run the model over all steps; ``grid`` has a row per step if the ids are known, else they are decoded."""
    long, more = divmod(n, lanes)
    out = grid if grid is not None else np.zeros((long + bool(more), lanes), np.int64)
    before1 = before2 = np.full(lanes, model.n, np.int64)
    for step in range(len(out)):
        active = lanes if step < long else more
        model.guesses(before2[:active], before1[:active])
        if grid is None:
            out[step, :active] = coder.ids(model)
        ids = out[step, :active]
        what, symbols = model.outcome(ids)
        coder.narrow(model.outcomes.take(what), CASE_BITS)
        coder.narrow(model.symbols.take(symbols), FREQUENCY_BITS)
        coder.settle(active)
        model.learn(ids, what, symbols)
        before2, before1 = before1, ids
    return out


def _lanes(n: int) -> int:
    return max(1, min(LANES, n // LEAST_PER_LANE))


def _runs(ids: np.ndarray, lanes: int) -> np.ndarray:
    """A row per step with the next id of every lane's run; runs differ by one id at most, the longer first."""
    long, more = divmod(len(ids), lanes)
    split = more * (long + 1)
    grid = np.zeros((long + bool(more), lanes), np.int64)
    grid[: long + 1, :more] = ids[:split].reshape(more, long + 1).T[: len(grid)]
    grid[:long, more:] = ids[split:].reshape(lanes - more, long).T
    return grid


def _joined(grid: np.ndarray, n: int) -> np.ndarray:
    """The ids of which ``_runs`` makes ``grid``."""
    long, more = divmod(n, grid.shape[1])
    return np.concatenate([grid[:, :more].T.ravel(), grid[:long, more:].T.ravel()])


def encode_block(ids: np.ndarray) -> bytes:
    """The bytes of a block of ids (0 to ``LARGEST_ID``)."""
    ids = np.asarray(ids)
    n = len(ids)
    if n and (ids.min() < 0 or ids.max() > LARGEST_ID):
        raise ValueError(f"ids must be 0 to {LARGEST_ID}")
    present = np.zeros(int(ids.max()) + 1 if n else 1, bool)
    present[ids.astype(np.intp)] = True
    numbers = np.cumsum(present) - 1
    lanes = _lanes(n)
    coder = _Encoder(lanes)
    _code(coder, _Model(max(1, int(numbers[-1]) + 1)), n, lanes, _runs(numbers[ids], lanes))
    sizes, words = coder.streams()
    used = zlib.compress(np.packbits(present).tobytes())
    body = struct.pack("<IIII", n, len(present), len(used), lanes) + used + sizes.tobytes() + words.tobytes()
    return MAGIC + struct.pack("<I", zlib.crc32(body)) + body


def decode_block(data: bytes) -> np.ndarray:
    """The ids of a block; raises ``CorruptBlock`` if its checksum does not hold."""
    if data[:4] != MAGIC or zlib.crc32(data[8:]) != struct.unpack_from("<I", data, 4)[0]:
        raise CorruptBlock("checksum or format of a block of ids does not hold")
    n, size, at, lanes = struct.unpack_from("<IIII", data, 8)
    present = np.unpackbits(np.frombuffer(zlib.decompress(data[24 : 24 + at]), np.uint8), count=size)
    used = np.flatnonzero(present)
    sizes = np.frombuffer(data, "<u4", lanes, 24 + at)
    words = np.frombuffer(data, "<u2", offset=24 + at + 4 * lanes)
    grid = _code(_Decoder(sizes, words), _Model(max(1, len(used))), n, lanes, None)
    return used[_joined(grid, n)]
