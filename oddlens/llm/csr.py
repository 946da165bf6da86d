"""Compressed sparse rows, built by hand, and their product by rows (Gustavson)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

#: Terms of a product that are held at once, if no single row has more.
TERMS = 4_000_000


def expand(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges (start, size), one range after the other."""
    total = np.cumsum(sizes)
    return np.arange(int(total[-1]) if len(total) else 0) + np.repeat(starts - (total - sizes), sizes)


@dataclass(frozen=True)
class Csr:
    """Row r holds ``data[k]`` in column ``columns[k]`` for k from ``rows[r]`` to ``rows[r + 1]``."""

    rows: np.ndarray
    columns: np.ndarray
    data: np.ndarray
    width: int

    @staticmethod
    def of_sizes(sizes: np.ndarray, columns: np.ndarray, width: int, data: np.ndarray | None = None) -> Csr:
        return Csr(np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]), columns, np.ones(len(columns), np.int64) if data is None else data, width)

    def row_numbers(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.rows) - 1), np.diff(self.rows))

    def transposed(self) -> Csr:
        by = np.argsort(self.columns, kind="stable")
        return Csr.of_sizes(np.bincount(self.columns, minlength=self.width), self.row_numbers()[by], len(self.rows) - 1, self.data[by])

    def chosen(self, rows: np.ndarray) -> Csr:
        """Only these rows, in this order."""
        sizes = np.diff(self.rows)[rows]
        at = expand(self.rows[rows], sizes)
        return Csr.of_sizes(sizes, self.columns[at], self.width, self.data[at])

    def _blocks(self, terms: np.ndarray) -> Iterator[tuple[int, int]]:
        """Ranges of rows with about ``TERMS`` terms each."""
        total = np.concatenate([[0], np.cumsum(terms)])
        first, n = 0, len(terms)
        while first < n:
            last = max(first + 1, int(np.searchsorted(total, total[first] + TERMS, "right")) - 1)
            yield first, last
            first = last

    def times(self, other: Csr) -> Csr:
        """The product: each row adds up the rows of ``other`` that its entries name, times the entries."""
        sizes = np.diff(other.rows)
        per_entry = sizes[self.columns]
        terms = np.diff(np.concatenate([[0], np.cumsum(per_entry)])[self.rows])
        counts, columns, data = [], [], []
        for first, last in self._blocks(terms):
            part = slice(self.rows[first], self.rows[last])
            mine, widths = self.columns[part], per_entry[part]
            at = expand(other.rows[mine], widths)
            row = np.repeat(np.repeat(np.arange(last - first), np.diff(self.rows[first : last + 1])), widths)
            key = row * other.width + other.columns[at]
            value = np.repeat(self.data[part], widths) * other.data[at]
            if len(key) and (key[1:] < key[:-1]).any():
                by = np.argsort(key, kind="stable")
                key, value = key[by], value[by]
            heads = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.empty(0, np.int64)
            rows, column = np.divmod(key[heads], max(1, other.width))
            counts.append(np.bincount(rows, minlength=last - first))
            columns.append(column)
            data.append(np.add.reduceat(value, heads) if len(heads) else value)
        empty = np.empty(0, np.int64)
        return Csr.of_sizes(np.concatenate([empty, *counts]), np.concatenate([empty, *columns]), other.width, np.concatenate([empty, *data]))
