"""Rows of different length in flat numpy arrays, and sparse matrices by hand (CSR)."""

from __future__ import annotations

import ctypes
import gc
from dataclasses import dataclass

import numpy as np

#: Products of single entries that one block of a matrix product may hold.
BLOCK = 1 << 19


def offsets(lengths: np.ndarray) -> np.ndarray:
    """Where each row starts, and the end of the last."""
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def take_rows(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of all entries of the rows (start, length), row after row."""
    at = offsets(lengths)
    return np.repeat(starts - at[:-1], lengths) + np.arange(at[-1])


def counted(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in ascending order and their total weight (without weights, how often each occurs)."""
    if not len(keys):
        return keys.astype(np.int64), np.zeros(0, np.int64)
    order = np.argsort(keys, kind="stable")
    held = keys[order]
    first = np.flatnonzero(np.concatenate(([True], held[1:] != held[:-1])))
    if weights is None:
        return held[first], np.diff(np.append(first, len(held)))
    return held[first], np.add.reduceat(weights[order], first)


def give_back() -> None:
    """Return freed memory to the system, where the C library can: a worker that waits holds what it once had."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        gc.collect()
        trim(0)


class Rows:
    """Rows of different length with several values an entry, each in as few bytes as it needs."""

    def __init__(self, lengths: np.ndarray, **values: np.ndarray):
        self.starts = offsets(lengths)
        self.values = {n: narrow(v) for n, v in values.items()}

    @property
    def lengths(self) -> np.ndarray:
        return np.diff(self.starts)

    def append(self, more: Rows) -> None:
        self.starts = np.concatenate((self.starts, self.starts[-1] + more.starts[1:]))
        self.values = {n: np.concatenate((v, more.values[n])) for n, v in self.values.items()}

    def take(self, rows: np.ndarray) -> Rows:
        lengths = self.lengths[rows]
        at = take_rows(self.starts[rows], lengths)
        return Rows(lengths, **{n: v[at] for n, v in self.values.items()})

    def of(self, name: str) -> np.ndarray:
        return self.values[name].astype(np.int64)


def narrow(x: np.ndarray) -> np.ndarray:
    """Whole numbers from 0 on in the narrowest type that holds them."""
    return x.astype(np.min_scalar_type(int(x.max()) if len(x) else 0))


@dataclass
class Csr:
    """A sparse matrix of whole numbers: row i holds ``values`` at ``columns`` from ``starts[i]`` to ``starts[i + 1]``."""

    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    n_columns: int

    @property
    def n_rows(self) -> int:
        return len(self.starts) - 1

    @classmethod
    def of(cls, rows: np.ndarray, columns: np.ndarray, shape: tuple[int, int], values: np.ndarray | None = None) -> Csr:
        """From entries in any order; equal places are added up."""
        keys, total = counted(rows.astype(np.int64) * max(shape[1], 1) + columns, values)
        at, columns = np.divmod(keys, max(shape[1], 1))
        return cls(offsets(np.bincount(at, minlength=shape[0])), columns, total, shape[1])

    def rows(self) -> np.ndarray:
        """The row of each entry."""
        return np.repeat(np.arange(self.n_rows), np.diff(self.starts))

    def transposed(self) -> Csr:
        order = np.argsort(self.columns, kind="stable")
        return Csr(offsets(np.bincount(self.columns, minlength=self.n_columns)), self.rows()[order], self.values[order],
                   self.n_rows)

    def times_vector(self, vector: np.ndarray) -> np.ndarray:
        """The product with a column of whole numbers, exact."""
        sums = np.zeros(len(self.values) + 1, np.int64)
        np.cumsum(self.values * vector[self.columns], out=sums[1:])
        return sums[self.starts[1:]] - sums[self.starts[:-1]]

    def product(self, other: Csr) -> Csr:
        """Gustavson's product: row i is the sum of ``other``'s rows that i's entries name, each times its entry.

        Rows go in blocks of at most ``BLOCK`` single products, or one row.
        """
        wide = np.diff(other.starts)[self.columns]
        work = offsets(wide)[self.starts]  # single products before each row
        parts, lengths, low = [], [], 0
        while low < self.n_rows:
            high = max(low + 1, int(np.searchsorted(work, work[low] + BLOCK, side="right")) - 1)
            own = slice(int(self.starts[low]), int(self.starts[high]))
            width = wide[own]
            at = take_rows(other.starts[:-1][self.columns[own]], width)
            row = np.repeat(np.repeat(np.arange(high - low), np.diff(self.starts[low:high + 1])), width)
            block = Csr.of(row, other.columns[at], (high - low, other.n_columns),
                           np.repeat(self.values[own], width) * other.values[at])
            parts.append((block.columns, block.values))
            lengths.append(np.diff(block.starts))
            low = high
        if not parts:
            none = np.zeros(0, np.int64)
            return Csr(np.zeros(1, np.int64), none, none, other.n_columns)
        return Csr(offsets(np.concatenate(lengths)), np.concatenate([c for c, _ in parts]),
                   np.concatenate([v for _, v in parts]), other.n_columns)
