"""Elias-Fano coding of non-decreasing integer sequences, with select structures.

A value is split at ``low`` bits: the low parts stand packed one after the other, the high parts as
a bit vector that has the k-th one at (high part + k). ``select`` finds the k-th one from a sample
of every 64th one's place (32-bit numbers) and population counts of the words after it, so any
value is read without decoding the others. Space: low + 2.5 bits a value.
"""

from __future__ import annotations

import struct

import numpy as np

#: One place is kept of so many ones.
SAMPLE = 64
_HEAD = struct.Struct("<QQBxxxIII")  # count, first value, low bits, words of low parts, of high parts, samples
_WORD = np.uint64(64)
_LAST = np.uint64(63)


def _packed(values: np.ndarray, bits: int) -> np.ndarray:
    """The lowest ``bits`` bits of each value, one after the other, in 64-bit words."""
    if not bits or not len(values):
        return np.zeros(0, np.uint64)
    out = np.zeros((len(values) * bits + 63) // 64 + 1, np.uint64)
    at = np.arange(len(values), dtype=np.uint64) * np.uint64(bits)
    word, shift = (at // _WORD).astype(np.int64), at % _WORD
    values = values & np.uint64((1 << bits) - 1)
    np.bitwise_or.at(out, word, values << shift)
    over = shift + np.uint64(bits) > _WORD
    np.bitwise_or.at(out, word[over] + 1, values[over] >> (_WORD - shift[over]))
    return out


class EliasFano:
    """A non-decreasing sequence; ``seq[i]`` takes a position or an array of them."""

    def __init__(self, count: int, first: int, low: int, lows: np.ndarray, highs: np.ndarray, samples: np.ndarray):
        self.count, self.first, self.low = count, first, low
        self.lows, self.highs, self.samples = lows, highs, samples

    @classmethod
    def of(cls, values) -> EliasFano:
        """Signed or unsigned 64-bit values in non-decreasing order; a sequence may be empty."""
        values = np.asarray(values)
        if not len(values):
            return cls(0, 0, 0, *(np.zeros(0, np.uint64),) * 2, np.zeros(0, np.uint32))
        first = int(values[0])
        rest = values.astype(np.uint64) - np.uint64(first % (1 << 64))  # modulo 2**64, so signs don't matter
        if (rest[1:] < rest[:-1]).any() or (values[1:] < values[:-1]).any():
            raise ValueError("values must not decrease")
        n, top = len(rest), int(rest[-1])
        low = max(0, (top // n).bit_length() - 1) if top >= n else 0
        place = (rest >> np.uint64(low)) + np.arange(n, dtype=np.uint64)
        if int(place[-1]) >= 1 << 32:
            raise ValueError("too many values for 32-bit samples")
        words = np.zeros(int(place[-1]) // 64 + 1, np.uint64)
        np.bitwise_or.at(words, (place // _WORD).astype(np.int64), np.uint64(1) << (place % _WORD))
        return cls(n, first, low, _packed(rest, low), words, place[::SAMPLE].astype(np.uint32))

    def __len__(self) -> int:
        return self.count

    def select(self, k: np.ndarray) -> np.ndarray:
        """Places of the k-th ones (from 0) of the high parts."""
        k = np.asarray(k, np.int64)
        place = self.samples[k // SAMPLE].astype(np.int64)
        left = (k % SAMPLE).astype(np.int64)  # ones to pass, the sampled one included
        word = place // 64
        now = self.highs[word] & ~((np.uint64(1) << (place % 64).astype(np.uint64)) - np.uint64(1))
        ones = np.bitwise_count(now).astype(np.int64)
        todo = np.flatnonzero(left >= ones)
        while len(todo):
            left[todo] -= ones[todo]
            word[todo] += 1
            now[todo] = self.highs[word[todo]]
            ones[todo] = np.bitwise_count(now[todo])
            todo = todo[left[todo] >= ones[todo]]
        todo = np.flatnonzero(left)
        while len(todo):
            now[todo] &= now[todo] - np.uint64(1)
            left[todo] -= 1
            todo = todo[left[todo] > 0]
        lowest = now & (~now + np.uint64(1))
        return word * 64 + np.bitwise_count(lowest - np.uint64(1)).astype(np.int64)

    def _low(self, k: np.ndarray) -> np.ndarray:
        if not self.low:
            return np.zeros(len(k), np.uint64)
        at = k.astype(np.uint64) * np.uint64(self.low)
        word, shift = (at // _WORD).astype(np.int64), at % _WORD
        value = self.lows[word] >> shift
        over = shift + np.uint64(self.low) > _WORD
        value[over] |= self.lows[word[over] + 1] << (_WORD - shift[over])
        return value & np.uint64((1 << self.low) - 1)

    def __getitem__(self, k):
        """int64 values at the positions."""
        places = np.atleast_1d(np.asarray(k, np.int64))
        if len(places) and (places.min() < 0 or places.max() >= self.count):
            raise IndexError(k)
        high = (self.select(places) - places).astype(np.uint64)
        values = ((high << np.uint64(self.low)) | self._low(places)) + np.uint64(self.first % (1 << 64))
        values = values.view(np.int64)
        return values if np.ndim(k) else int(values[0])

    def to_bytes(self) -> bytes:
        head = _HEAD.pack(self.count, self.first % (1 << 64), self.low, len(self.lows), len(self.highs), len(self.samples))
        return head + b"".join(a.astype(a.dtype.newbyteorder("<")).tobytes() for a in (self.lows, self.highs, self.samples))

    @classmethod
    def from_bytes(cls, raw: bytes) -> EliasFano:
        count, first, low, n_low, n_high, n_sample = _HEAD.unpack_from(raw)
        at, parts = _HEAD.size, []
        for kind, n in (("<u8", n_low), ("<u8", n_high), ("<u4", n_sample)):
            parts.append(np.frombuffer(raw, kind, n, at))
            at += n * parts[-1].itemsize
        return cls(count, first, low, *parts)
