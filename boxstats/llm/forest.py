"""Links found in one task, cut down to as many as keep the same things connected."""

from __future__ import annotations

import numpy as np


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (id, smallest id it is connected with) for the links a-b; at most one pair an id."""
    if not len(a):
        return a, b
    ids, ends = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(ids))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        while (again := new[new]).tobytes() != new.tobytes():
            new = again
        new = new[root]
        if np.array_equal(new, root):
            break
        root = new
    moved = root != np.arange(len(ids))
    return ids[moved], ids[root[moved]]
