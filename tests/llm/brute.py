"""Plain single-machine versions to test against."""

from itertools import combinations


def component_of(prints, limit):
    """Smallest member reachable for each (id, number) pair, by comparing all pairs."""
    parent = {i: i for i in prints}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in combinations(prints, 2):
        if (prints[a] ^ prints[b]).bit_count() <= limit:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in prints}
