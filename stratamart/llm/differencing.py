"""Karmarkar-Karp multiway differencing: numbers into groups with near-equal sums."""

from __future__ import annotations

import heapq

import numpy as np


def differencing(sizes: list[int], groups: int) -> list[list[int]]:
    """Indices of ``sizes`` in ``groups`` groups.

    Every number starts as a partial partition with one filled group. The two partial partitions with the
    largest imbalance are merged, the heavy groups of one meeting the light groups of the other, until one is left.
    """
    if groups == 1:
        return [list(range(len(sizes)))]
    parts: list[tuple[int, int]] = []  # unions: node len(sizes) + i joins the two nodes of entry i
    heap = []
    for index, size in enumerate(sizes):
        heap.append((-size, index, np.array([size], np.int64), np.array([index], np.int64)))
    heapq.heapify(heap)
    serial = len(sizes)
    while len(heap) > 1:
        _, _, sums_a, nodes_a = heapq.heappop(heap)
        _, _, sums_b, nodes_b = heapq.heappop(heap)
        # Groups are held in descending order and only the filled ones; the others are level zero.
        a, b = len(sums_a), len(sums_b)
        both = max(0, a + b - groups)  # this many filled groups of each side must share
        sums = np.concatenate([sums_a[:a - both], sums_b[:b - both], sums_a[a - both:] + sums_b[b - both:][::-1]])
        shared = []
        for left, right in zip(nodes_a[a - both:].tolist(), nodes_b[b - both:][::-1].tolist()):
            shared.append(len(sizes) + len(parts))
            parts.append((left, right))
        nodes = np.concatenate([nodes_a[:a - both], nodes_b[:b - both], np.array(shared, np.int64)])
        order = np.argsort(-sums, kind="stable")
        sums, nodes = sums[order], nodes[order]
        if len(sums) == groups:
            sums = sums - sums[-1]
        spread = int(sums[0]) if len(sums) < groups else int(sums[0] - sums[-1])
        heapq.heappush(heap, (-spread, serial, sums, nodes))
        serial += 1
    out = []
    for node in heap[0][3].tolist() if heap else []:
        members, todo = [], [node]
        while todo:
            top = todo.pop()
            if top < len(sizes):
                members.append(top)
            else:
                todo.extend(parts[top - len(sizes)])
        out.append(members)
    return out
