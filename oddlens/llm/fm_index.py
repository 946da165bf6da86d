"""FM-index of one shard of word sequences, in numpy.

The shard's documents, each closed by an end mark, are one sequence of symbols: 0 is the
end mark, the others number the shard's distinct words. The suffix array is sorted by
doubling, first by several symbols at once, then only what is still tied; end marks count
as different, so no comparison leaves its document. The Burrows-Wheeler transform is kept
as a wavelet tree in matrix layout (on each level the zeros stand before the ones), whose
ranks answer backward searches; every ``SAMPLE``-th position of each document is kept, so
an occurrence is located after fewer than that many steps back.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

#: Distance of the sampled positions of a document.
SAMPLE = 16


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Start of each suffix in order; 0 marks document ends, the last symbol is one."""
    n = len(symbols)
    ends = np.flatnonzero(symbols == 0)
    own = symbols.astype(np.int64) + (len(ends) - 1)
    own[ends] = np.arange(len(ends))  # no two ends are equal
    width = max(1, int(own.max()).bit_length())
    depth = max(1, 63 // width)
    padded = np.concatenate([own, np.zeros(depth, np.int64)])
    key = np.zeros(n, np.int64)
    for k in range(depth):
        key = (key << width) | padded[k : k + n]
    order = np.argsort(key)
    sorted_key = key[order]
    heads = np.append(True, sorted_key[1:] != sorted_key[:-1])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(heads, np.arange(n), 0))
    slots = np.flatnonzero(~(heads & np.append(heads[1:], True)))
    while len(slots):
        tied = order[slots]
        key = rank[tied] * n + rank[tied + depth]
        by = np.argsort(key)
        tied, key = tied[by], key[by]
        order[slots] = tied
        heads = np.append(True, key[1:] != key[:-1])
        rank[tied] = slots[np.maximum.accumulate(np.where(heads, np.arange(len(slots)), 0))]
        slots = slots[~(heads & np.append(heads[1:], True))]
        depth *= 2
    return order


class Bits:
    """A bit field with ranks."""

    def __init__(self, packed: bytes | np.ndarray):
        self.words = np.frombuffer(packed, np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    @staticmethod
    def pack(bits: np.ndarray) -> bytes:
        """64 bits a word, and a last word that is never full, so that the end has a rank too."""
        packed = np.packbits(bits, bitorder="little").tobytes()
        return packed + bytes(8 * (len(bits) // 64 + 1) - len(packed))

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) != 0


def build(symbols: np.ndarray, n_symbols: int) -> dict[str, bytes]:
    """The parts of the index of a sequence, as bytes: counts, levels, marks, samples, starts."""
    n = len(symbols)
    order = suffix_array(symbols)
    ends = np.flatnonzero(symbols == 0)
    starts = np.concatenate([[0], ends[:-1] + 1])
    inside = np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n)))
    sampled = (inside % SAMPLE == 0)[order]
    rest = symbols[order - 1].astype(np.int32)
    levels = []
    for bit in reversed(range(max(1, (n_symbols - 1).bit_length()))):
        ones = (rest >> bit) & 1 != 0
        levels.append(Bits.pack(ones))
        rest = np.concatenate([rest[~ones], rest[ones]])
    return {
        "counts": np.bincount(symbols, minlength=n_symbols).astype("<i4").tobytes(),
        "levels": b"".join(levels),
        "marks": Bits.pack(sampled),
        "samples": order[sampled].astype("<i4").tobytes(),
        "starts": starts.astype("<i4").tobytes(),
    }


class FmIndex:
    def __init__(self, counts: bytes, levels: bytes, marks: bytes, samples: bytes, starts: bytes):
        sizes = np.frombuffer(counts, "<i4").astype(np.int64)
        self.n = int(sizes.sum())
        self.depth = max(1, (len(sizes) - 1).bit_length())
        step = 8 * (self.n // 64 + 1)
        self.levels = [Bits(levels[k : k + step]) for k in range(0, step * self.depth, step)]
        self.zeros = [self.n - int(b.before[-1]) for b in self.levels]
        self.first = np.concatenate([[0], np.cumsum(sizes)])  # of the suffixes that begin with a symbol
        # Below the last level symbols stand in the order of their reversed bits.
        codes, turned = np.arange(len(sizes)), np.zeros(len(sizes), np.int64)
        for k in range(self.depth):
            turned = (turned << 1) | ((codes >> k) & 1)
        by = np.argsort(turned)
        stands = np.empty(len(sizes), np.int64)
        stands[by] = np.cumsum(sizes[by]) - sizes[by]
        self.shift = self.first[:-1] - stands
        self.marks = Bits(marks)
        self.samples = np.frombuffer(samples, "<i4").astype(np.int64)
        self.starts = np.frombuffer(starts, "<i4").astype(np.int64)

    def _back(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Bound of the suffixes of a range's end ``at`` with ``symbols`` put before them."""
        for k, (bits, zeros) in enumerate(zip(self.levels, self.zeros, strict=True)):
            ones = bits.rank(at)
            at = np.where((symbols >> (self.depth - 1 - k)) & 1, zeros + ones, at - ones)
        return self.shift[symbols] + at

    def previous(self, rows: np.ndarray) -> np.ndarray:
        """Row of the suffix that begins one word earlier (not before a document's start)."""
        at, symbols = rows, np.zeros(len(rows), np.int64)
        for bits, zeros in zip(self.levels, self.zeros, strict=True):
            ones, bit = bits.rank(at), bits.get(at)
            at = np.where(bit, zeros + ones, at - ones)
            symbols = (symbols << 1) | bit
        return self.shift[symbols] + at

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Range of rows of each phrase (symbols, one phrase a row); an empty range has equal ends."""
        low, high = np.zeros(len(phrases), np.int64), np.zeros(len(phrases), np.int64)
        alive = np.flatnonzero(lengths > 0)
        for k in range(int(lengths.max(initial=0))):
            alive = alive[lengths[alive] > k]
            symbols = phrases[alive, lengths[alive] - 1 - k]
            if k:
                low[alive], high[alive] = self._back(symbols, low[alive]), self._back(symbols, high[alive])
            else:
                low[alive], high[alive] = self.first[symbols], self.first[symbols + 1]
            gone = low[alive] >= high[alive]
            low[alive[gone]] = high[alive[gone]] = 0
            alive = alive[~gone]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Place in the sequence of each row's suffix."""
        found = np.empty(len(rows), np.int64)
        open_, steps = np.arange(len(rows)), 0
        while len(open_):
            marked = self.marks.get(rows)
            found[open_[marked]] = self.samples[self.marks.rank(rows[marked])] + steps
            open_, rows = open_[~marked], rows[~marked]
            rows = self.previous(rows)
            steps += 1
        return found


def ranges(low: np.ndarray, high: np.ndarray, most: int) -> Sequence[tuple[np.ndarray, np.ndarray]]:
    """(number of the range, row) of all rows of the ranges, about ``most`` rows at a time."""
    sizes = high - low
    total = np.cumsum(sizes)
    for a in range(0, int(total[-1]) if len(total) else 0, most):
        places = np.arange(a, min(a + most, int(total[-1])))
        owner = np.searchsorted(total, places, "right")
        yield owner, low[owner] + places - (total[owner] - sizes[owner])
