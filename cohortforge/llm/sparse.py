"""Sparse matrices in compressed rows, and their product row by row."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BLOCK = 1 << 20         # products that are held at once


@dataclass
class Rows:
    """Row i has ``data[starts[i]:starts[i + 1]]`` in the columns ``columns[starts[i]:starts[i + 1]]``, in ascending order."""

    starts: np.ndarray
    columns: np.ndarray
    data: np.ndarray
    width: int

    @classmethod
    def of_runs(cls, sizes: np.ndarray) -> Rows:
        """One row per run, with a 1 in each place that it covers; the runs lie side by side."""
        starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        n = int(starts[-1])
        return cls(starts, np.arange(n), np.ones(n, np.int64), n)

    @classmethod
    def of_members(cls, group: np.ndarray, width: int) -> Rows:
        """One row per member with a 1 in its group's column."""
        return cls(np.arange(len(group) + 1), np.asarray(group, np.int64), np.ones(len(group), np.int64), width)

    def row_of_each(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))

    def transposed(self) -> Rows:
        """Counted by column, then placed in row order."""
        starts = np.concatenate([[0], np.cumsum(np.bincount(self.columns, minlength=self.width))]).astype(np.int64)
        order = np.argsort(self.columns, kind="stable")
        return Rows(starts, self.row_of_each()[order], self.data[order], len(self.starts) - 1)

    def product(self, other: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, column, value) of the product's entries by Gustavson's rule, in row and column order.

        Row i of the product is the sum of the rows k of ``other`` times the
        value in (i, k).  Rows are taken in blocks of about ``BLOCK`` products.
        """
        reach = np.diff(other.starts)[self.columns]                     # products of each entry
        done = np.concatenate([[0], np.cumsum(reach)])[self.starts]     # products before each row
        rows, columns, values = [], [], []
        a, n = 0, len(self.starts) - 1
        while a < n:
            b = min(n, max(a + 1, int(np.searchsorted(done, done[a] + BLOCK, "right")) - 1))
            lo, hi = self.starts[a], self.starts[b]
            count = reach[lo:hi]
            total = int(count.sum())
            if total:
                row = np.repeat(np.repeat(np.arange(a, b), np.diff(self.starts[a:b + 1])), count)
                at = np.arange(total) + np.repeat(other.starts[self.columns[lo:hi]] - np.concatenate([[0], np.cumsum(count)[:-1]]), count)
                column, value = other.columns[at], other.data[at] * np.repeat(self.data[lo:hi], count)
                key = (row - a) * other.width + column
                if (key[1:] < key[:-1]).any():
                    order = np.argsort(key, kind="stable")
                    key, row, column, value = key[order], row[order], column[order], value[order]
                first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
                rows.append(row[first])
                columns.append(column[first])
                values.append(np.add.reduceat(value, first))
            a = b
        return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (rows, columns, values))
