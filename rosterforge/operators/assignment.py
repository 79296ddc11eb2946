"""Maximum-weight bipartite matching for small matrices (columns of two schema versions)."""

from __future__ import annotations

from collections.abc import Sequence


def best_matching(weights: Sequence[Sequence[float]], least: float) -> list[tuple[int, int]]:
    """Row-column pairs of the matching with the greatest sum of weights.

    Shortest augmenting paths with potentials, O(n^2 m). Pairs lighter than
    ``least`` count as weightless and are left out of the result. An empty
    matrix gives no pairs; among equal sums the lower indices win.
    """
    rows, cols = len(weights), len(weights[0]) if weights else 0
    if not rows or not cols:
        return []
    if rows > cols:
        turned = [[weights[r][c] for r in range(rows)] for c in range(cols)]
        return sorted((r, c) for c, r in best_matching(turned, least))
    cost = [[-w if w >= least else 0.0 for w in row] for row in weights]
    inf = float("inf")
    row_pot, col_pot = [0.0] * rows, [0.0] * (cols + 1)
    owner = [-1] * (cols + 1)  # the extra last column roots each search
    for r in range(rows):
        owner[cols], col = r, cols
        dist, back, done = [inf] * cols, [cols] * cols, [False] * (cols + 1)
        while owner[col] != -1:
            done[col] = True
            at, step, nearest = owner[col], inf, -1
            for c in range(cols):
                if done[c]:
                    continue
                reduced = cost[at][c] - row_pot[at] - col_pot[c]
                if reduced < dist[c]:
                    dist[c], back[c] = reduced, col
                if dist[c] < step:
                    step, nearest = dist[c], c
            for c in range(cols + 1):
                if done[c]:
                    row_pot[owner[c]] += step
                    col_pot[c] -= step
                elif c < cols:
                    dist[c] -= step
            col = nearest
        while col != cols:
            owner[col] = owner[back[col]]
            col = back[col]
    return sorted((owner[c], c) for c in range(cols) if owner[c] != -1 and weights[owner[c]][c] >= least)
