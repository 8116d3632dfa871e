"""Connected components, plainly."""

from __future__ import annotations


def roots_of(nodes, pairs):
    """The smallest node that each one reaches."""
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in pairs:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    return {n: find(n) for n in nodes}
