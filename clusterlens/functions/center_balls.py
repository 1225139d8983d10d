"""Exact nearest centre among many, most centres never looked at.

The centres are put into about sqrt(k) balls: a pivot, the centres nearest to
it, and the radius that holds them. By the triangle inequality no centre of a
ball is closer to a point than the pivot's distance less the radius, so a ball
whose bound lies above the best distance so far is left out for that point. The
result is the one of comparing with every centre, ties to the lowest position
included: bounds and comparisons leave room for rounding, and rows whose two
best centres are within it are decided by exact differences.

How much is left out depends on the data: near all of it in a few dimensions or
where centres cluster, little where all distances are alike. ``compared``
counts the distances that a batch took.
"""

from __future__ import annotations

import numpy as np

# grouping refines the pivots this often; more steps tighten the balls little
STEPS = 4
# entries of one block of distances
BUDGET = 4 * 1024 * 1024


def _squared(x: np.ndarray, xx: np.ndarray, c: np.ndarray, cc: np.ndarray) -> np.ndarray:
    return xx[:, None] - 2.0 * (x @ c.T) + cc[None, :]


class CenterBalls:
    """Balls over the rows of ``c``; made once per centre set and task."""

    def __init__(self, c: np.ndarray, balls: int | None = None):
        k = len(c)
        g = min(k, balls or max(1, int(np.ceil(np.sqrt(k)))))
        self.c = c
        norms = np.einsum("ij,ij->i", c, c)
        self.largest = float(norms.max()) if k else 0.0
        pivots = c[np.linspace(0, k - 1, g).astype(int)].copy()
        for step in range(STEPS + 1):
            home = self._homes(c, norms, pivots)
            if step < STEPS:
                total = np.zeros_like(pivots)
                np.add.at(total, home, c)
                n = np.bincount(home, minlength=g)
                pivots[n > 0] = total[n > 0] / n[n > 0][:, None]
        self.members, self.inner, self.norms = [], [], []
        kept, radius = [], []
        for j in range(g):
            at = np.flatnonzero(home == j)
            if len(at):
                kept.append(j)
                radius.append(np.sqrt(((c[at] - pivots[j]) ** 2).sum(axis=1)).max())
                self.members.append(at)
                self.inner.append(np.ascontiguousarray(c[at]))
                self.norms.append(norms[at])
        self.pivots = pivots[kept]
        self.pivot_norms = np.einsum("ij,ij->i", self.pivots, self.pivots)
        self.radius = np.array(radius)
        self.compared = 0

    @staticmethod
    def _homes(c: np.ndarray, norms: np.ndarray, pivots: np.ndarray) -> np.ndarray:
        home = np.empty(len(c), np.int64)
        pp = np.einsum("ij,ij->i", pivots, pivots)
        step = max(1, BUDGET // len(pivots))
        for s in range(0, len(c), step):
            home[s:s + step] = _squared(c[s:s + step], norms[s:s + step], pivots, pp).argmin(axis=1)
        return home

    def candidates(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Position of the best centre of every row, and the rows that exact
        differences must decide."""
        best = np.empty(len(x), np.int64)
        close = np.zeros(len(x), bool)
        step = max(1, BUDGET // len(self.pivots))
        for s in range(0, len(x), step):
            best[s:s + step], close[s:s + step] = self._search(x[s:s + step])
        return best, np.flatnonzero(close)

    def _search(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        xx = np.einsum("ij,ij->i", x, x)
        # far wider than the product form's rounding, as in nearest_numpy
        room = 1e-9 * (xx + self.largest) + 1e-300
        to_pivot = _squared(x, xx, self.pivots, self.pivot_norms)
        self.compared += to_pivot.size
        nearest = to_pivot.argmin(axis=1)
        bound = np.sqrt(np.maximum(to_pivot - room[:, None], 0.0))
        bound -= self.radius * (1 + 1e-9)
        best = np.zeros(len(x), np.int64)
        first, second = np.full(len(x), np.inf), np.full(len(x), np.inf)

        def visit(ball: int, rows: np.ndarray) -> None:
            d2 = _squared(x[rows], xx[rows], self.inner[ball], self.norms[ball])
            self.compared += d2.size
            at = d2.argmin(axis=1)
            line = np.arange(len(rows))
            low = d2[line, at]
            if d2.shape[1] > 1:
                d2[line, at] = np.inf
                next_ = d2.min(axis=1)
            else:
                next_ = np.inf
            old = first[rows]
            second[rows] = np.minimum(np.minimum(second[rows], next_), np.maximum(old, low))
            won = low < old
            best[rows[won]] = self.members[ball][at[won]]
            first[rows] = np.minimum(old, low)

        order = np.argsort(nearest, kind="stable")
        cuts = np.flatnonzero(np.diff(nearest[order], prepend=-1))
        for lo, hi in zip(cuts, np.append(cuts[1:], len(order))):
            visit(int(nearest[order[lo]]), order[lo:hi])
        for ball in range(len(self.pivots)):
            reach = np.sqrt(np.maximum(first, 0.0) + 2 * room)
            rows = np.flatnonzero((bound[:, ball] <= reach) & (nearest != ball))
            if len(rows):
                visit(ball, rows)
        return best, second - first <= room
