"""The best rows per query that a task has seen, kept while it scores block after block."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


class TaskBest:
    """At most ``k`` rows for each of some queries: highest score first, then lowest key."""

    def __init__(self, queries: list, k: int):
        self.queries, self.k = queries, k
        self.best: list[list] = [[] for _ in queries]
        self.floors = np.full(len(queries), -np.inf)

    def add(self, scores: np.ndarray, keys: pa.Array) -> None:
        """Scores of some rows, one column per query; -inf where a row does not count."""
        if len(scores) > self.k:
            at = len(scores) - self.k
            self.floors = np.maximum(self.floors, np.partition(scores, at, axis=0)[at])
        # Only rows that reach a query's k-th best so far are looked at.
        q_at, row_at = np.nonzero(((scores >= self.floors) & (scores > -np.inf)).T)
        names = keys.take(pa.array(row_at)).to_pylist()
        ends = np.searchsorted(q_at, np.arange(len(self.queries) + 1))
        for q in np.unique(q_at):
            found = slice(ends[q], ends[q + 1])
            values = (-scores[row_at[found], q]).tolist()
            self.best[q] = sorted(self.best[q] + list(zip(values, names[found], strict=True)))[: self.k]
            if len(self.best[q]) == self.k:
                self.floors[q] = max(self.floors[q], -self.best[q][-1][0])

    def rows(self) -> list[tuple]:
        """``(query, key, score)`` of all rows kept."""
        return [(self.queries[q], key, -s) for q, hits in enumerate(self.best) for s, key in hits]
