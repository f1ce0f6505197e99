"""Karmarkar-Karp multiway differencing on partial partitions.

A partial partition is a vector of ``k`` subset sums, kept in falling order.
Its spread is the largest sum less the smallest.  Again and again the two
partial partitions of largest spread are combined, the largest subset of one
with the smallest of the other, until one partition is left.
"""

from __future__ import annotations

import heapq

import numpy as np


def difference(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Combine ``n`` partial partitions of ``k`` subsets each.

    ``vectors``: (n, k) integers, in any order.  Returns ``(place, loads)``:
    ``place[i, j]`` is the final subset of subset ``j`` of vector ``i``, and
    ``loads`` are the final sums, falling.  No vectors: empty ``place``, zero loads.
    """
    n, k = vectors.shape
    if n == 0:
        return np.zeros((0, k), np.int32), np.zeros(k, np.int64)
    order = np.argsort(-vectors, axis=1, kind="stable")
    sums = list(np.take_along_axis(vectors, order, axis=1).astype(np.int64))
    heap = [(int(s[-1] - s[0]), i) for i, s in enumerate(sums)]
    heapq.heapify(heap)
    made = []
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        both = sums[a] + sums[b][::-1]
        by = np.argsort(-both, kind="stable")
        both = both[by]
        sums[a] = sums[b] = None
        sums.append(both)
        made.append((a, b, by))
        heapq.heappush(heap, (int(both[-1] - both[0]), len(sums) - 1))
    root = heap[0][1]
    at = [None] * len(sums)
    at[root] = np.arange(k, dtype=np.int32)
    for node in range(len(sums) - 1, n - 1, -1):
        a, b, by = made[node - n]
        # sorted place j of the combined node held subset by[j] of a, and by[j] counted from b's end
        inner = np.empty(k, np.int32)
        inner[by] = at[node]
        at[a], at[b], at[node] = inner, inner[::-1], None
    place = np.empty((n, k), np.int32)
    for i in range(n):
        place[i, order[i]] = at[i]
    return place, sums[root]


def items(weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Divide single items over ``k`` subsets; returns each item's subset and the sums.

    An item starts as a partition with one filled subset.
    """
    n = len(weights)
    if n == 0:
        return np.zeros(0, np.int32), np.zeros(k, np.int64)
    if k == 1:
        return np.zeros(n, np.int32), np.array([int(np.sum(weights))], np.int64)
    vectors = np.zeros((n, k), np.int64)
    vectors[:, 0] = weights
    place, loads = difference(vectors)
    return place[:, 0].copy(), loads
