"""Hashed words and word starts of many texts at once, in numpy.

A word is a run of ASCII letters and digits and of characters beyond ASCII, in lower case.
Its hash is a polynomial over its bytes, a difference of prefix sums, so the words of a
buffer of texts and their starts are hashed without a step of Python for each.
"""

from __future__ import annotations

import string
from collections.abc import Iterable, Iterator, Sequence
from functools import cached_property

import numpy as np

from oddlens.llm.linear import BITS, PREFIXES

#: Bytes of texts that are hashed at once; a longer text is cut at a blank.
BUFFER = 2_000_000

IS_WORD = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])
_BLANK = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f"))
_INNER = ~_BLANK & ~np.isin(np.arange(256), list(string.punctuation.encode()))
_LEAD = np.array([b & 0xC0 != 0x80 for b in range(256)])
_rng = np.random.default_rng(11)
_BYTES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_SALTS = _rng.integers(1, 1 << 63, 1 + len(PREFIXES), dtype=np.uint64)
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64."""
    if len(_powers.get("up", ())) < n:
        size = max(n, BUFFER + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _powers[name] = np.multiply.accumulate(factors)
    return _powers["up"], _powers["down"]


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser that lets every bit reach every other (uint64, wraps around)."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        edges = np.concatenate([[0], edges])
    return edges[::2], edges[1::2]


class Scan:
    """The words of one buffer of lower-case UTF-8 that ends with a byte outside words."""

    def __init__(self, data: bytes):
        self.data = np.frombuffer(data, np.uint8)
        self.starts, self.ends = self._spans()
        up, self._down = _power(len(self.data))
        self._sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[self.data] * up[: len(self.data)], dtype=np.uint64)])
        self._leads = np.flatnonzero(_LEAD[self.data])

    def _spans(self) -> tuple[np.ndarray, np.ndarray]:
        return _runs(IS_WORD[self.data])

    @cached_property
    def _first(self) -> np.ndarray:
        return np.searchsorted(self._leads, self.starts)

    def _hash(self, starts: np.ndarray, ends: np.ndarray, kind: int) -> np.ndarray:
        return mixed((self._sums[ends] - self._sums[starts]) * self._down[starts] + _SALTS[kind])

    @cached_property
    def words(self) -> np.ndarray:
        return self._hash(self.starts, self.ends, 0)

    @cached_property
    def heads(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """(word, hash) of the starts of each length, of the words that are longer."""
        found = []
        for kind, length in enumerate(PREFIXES, 1):
            after = self._first + length
            stop = self._leads[np.minimum(after, len(self._leads) - 1)]
            longer = np.flatnonzero((after < len(self._leads)) & (stop < self.ends))
            found.append((longer, self._hash(self.starts[longer], stop[longer], kind)))
        return found

    def single(self) -> np.ndarray:
        """Which words are one character."""
        after = np.minimum(self._first + 1, len(self._leads) - 1)
        return self._leads[after] >= self.ends


class TokenScan(Scan):
    """The blank-separated tokens of a buffer, without the punctuation around them unless they are nothing else."""

    def __init__(self, data: bytes):
        super().__init__(data)
        #: Hashes of the tokens as they stand.
        self.whole = self._hash(self.starts, self.ends, 0)
        inner = np.flatnonzero(_INNER[self.data])
        i, j = np.searchsorted(inner, self.starts), np.searchsorted(inner, self.ends)
        some = np.flatnonzero(j > i)
        self.starts[some], self.ends[some] = inner[i[some]], inner[j[some] - 1] + 1

    def _spans(self) -> tuple[np.ndarray, np.ndarray]:
        return _runs(~_BLANK[self.data])

    def only(self, chosen: np.ndarray) -> None:
        """Leaves the chosen tokens; asked for before any hash of words or starts."""
        self.starts, self.ends = self.starts[chosen], self.ends[chosen]


def lowered(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "surrogatepass")


def _pieces(texts: Sequence[str | None]) -> Iterator[tuple[int, bytes]]:
    for k, text in enumerate(texts):
        data, at = lowered(text), 0
        while len(data) - at > BUFFER:
            cut = max(data.rfind(b" ", at + 1, at + BUFFER), data.rfind(b"\n", at + 1, at + BUFFER))
            cut = cut if cut > 0 else at + BUFFER
            yield k, data[at:cut]
            at = cut
        yield k, data[at:] if at else data


def scans(texts: Sequence[str | None], kind: type[Scan] = Scan) -> Iterator[tuple[Scan, np.ndarray, np.ndarray]]:
    """Buffers of whole texts or parts of long ones: the scan, the end of each piece, and its text's number."""
    held: list[tuple[int, bytes]] = []
    size = 0
    for k, data in _pieces(texts):
        if held and size + len(data) > BUFFER:
            yield _scan(held, kind)
            held, size = [], 0
        held.append((k, data))
        size += len(data) + 1
    if held:
        yield _scan(held, kind)


def _scan(held: list[tuple[int, bytes]], kind: type[Scan]) -> tuple[Scan, np.ndarray, np.ndarray]:
    ends = np.cumsum([len(d) + 1 for _, d in held])
    return kind(b"\n".join([d for _, d in held]) + b"\n"), ends, np.array([k for k, _ in held])


def scan_slots(scan: Scan, ends: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Sorted distinct (text << BITS | slot) of a buffer's words and their starts."""
    piece = np.searchsorted(ends, scan.starts, "right")
    base = piece.astype(np.uint32) << np.uint32(BITS) if len(ends) < 1 << (32 - BITS) else piece.astype(np.uint64) << np.uint64(BITS)
    mask = base.dtype.type((1 << BITS) - 1)
    keys = [base | (scan.words.astype(base.dtype) & mask)]
    keys += [base[longer] | (found.astype(base.dtype) & mask) for longer, found in scan.heads]
    all_ = np.sort(np.concatenate(keys))
    all_ = all_[np.append(True, all_[1:] != all_[:-1])] if len(all_) else all_
    return numbers[(all_ >> base.dtype.type(BITS)).astype(np.int64)] << BITS | (all_ & mask).astype(np.int64)


def text_rows(keys: list[np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of slots of each of ``n`` texts, and all slots, from the buffers' keys."""
    all_ = np.concatenate([np.empty(0, np.int64), *keys])
    if (all_[1:] <= all_[:-1]).any():  # a long text lies in several buffers
        all_ = np.unique(all_)
    return np.bincount(all_ >> BITS, minlength=n), (all_ & ((1 << BITS) - 1)).astype(np.int32)


def slots_of(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed features of each text, in ascending order: their numbers, and all slots."""
    return text_rows([scan_slots(*s) for s in scans(texts)], len(texts))


def token_slots(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of each text, one entry for each different token and each of its starts:
    their numbers, and all slots, in the order of the tokens' first places."""
    keys, owners, rows = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty((0, 1 + len(PREFIXES)), np.int32)]
    for scan, ends, numbers in scans(texts, TokenScan):
        owner = numbers[np.searchsorted(ends, scan.starts, "right")]
        key = mixed(scan.whole + owner.astype(np.uint64) * np.uint64(_BASE))
        first = np.sort(np.unique(key, return_index=True)[1])
        scan.only(first)
        row = np.full((len(first), 1 + len(PREFIXES)), -1, np.int32)
        row[:, 0] = _slots(scan.words)
        for k, (longer, found) in enumerate(scan.heads, 1):
            row[longer, k] = _slots(found)
        keys.append(key[first])
        owners.append(owner[first])
        rows.append(row)
    owner, row = np.concatenate(owners), np.concatenate(rows)
    if len(rows) > 2:  # a long text lies in several buffers
        first = np.sort(np.unique(np.concatenate(keys), return_index=True)[1])
        owner, row = owner[first], row[first]
    return np.bincount(owner, weights=(row >= 0).sum(axis=1), minlength=len(texts)).astype(np.int64), row[row >= 0]


def term_hashes(names: Sequence[str]) -> np.ndarray:
    """Hashes of named terms: a word, or '4 abcd' for the start of that length of a longer word."""
    found = np.empty(len(names), np.uint64)
    for k, name in enumerate(names):
        head, _, tail = name.partition(" ")
        word = lowered(tail or head)
        scan = Scan(word + b"\n")
        kind = PREFIXES.index(int(head)) + 1 if tail else 0
        found[k] = scan._hash(np.array([0]), np.array([len(word)]), kind)[0]
    return found


def summed(weights: np.ndarray, sizes: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Sum of the weights (last axis: slots) of each text's slots; the order of addition depends on the text only."""
    filled = np.flatnonzero(sizes)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])[filled].astype(np.int64)
    out = np.zeros((*weights.shape[:-1], len(sizes)))
    if len(filled):
        out[..., filled] = np.add.reduceat(weights[..., slots], starts, axis=-1)
    return out


class Terms:
    """Looks up known terms, given by their sorted 64-bit hashes, in many texts at once."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        self.sieve = np.zeros(1 << BITS, bool)
        self.sieve[_slots(hashes)] = True

    def rows(self, scanned: Iterable[tuple[Scan, np.ndarray, np.ndarray]], n: int) -> tuple[np.ndarray, np.ndarray]:
        """Terms of each of ``n`` scanned texts, as places in ``hashes``, ascending, each as often as
        it has different words: their numbers, and all places."""
        keys, words = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
        for scan, ends, numbers in scanned:
            for owner, found in sifted(scan, self.sieve):
                at = np.searchsorted(self.hashes, found)
                known = np.flatnonzero(self.hashes[np.minimum(at, len(self.hashes) - 1)] == found) if len(self.hashes) else np.empty(0, np.int64)
                keys.append(numbers[np.searchsorted(ends, scan.starts[owner[known]], "right")] << 32 | at[known])
                words.append(scan.words[owner[known]])
        all_, word = np.concatenate(keys), np.concatenate(words)
        by = np.lexsort((word, all_))
        all_, word = all_[by], word[by]
        all_ = all_[np.append(True, (all_[1:] != all_[:-1]) | (word[1:] != word[:-1]))] if len(all_) else all_
        return np.bincount(all_ >> 32, minlength=n), (all_ & 0xFFFFFFFF).astype(np.int32)


def _slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64((1 << BITS) - 1)).astype(np.int64)


def sifted(scan: Scan, sieve: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word, hash) of the words and word starts of a buffer whose slot is in the sieve."""
    words = scan.words
    kept = np.flatnonzero(sieve[_slots(words)])
    yield kept, words[kept]
    for longer, found in scan.heads:
        kept = np.flatnonzero(sieve[_slots(found)])
        yield longer[kept], found[kept]
