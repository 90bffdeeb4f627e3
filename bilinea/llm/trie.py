"""The walk over pairs of nodes of a binary trie, within a task.

A fingerprint is a path of 64 bits. The walk goes from a pair of nodes to the pairs of their children, adds up the bits
in which the two paths differ, and prunes a pair once they differ in more than the budget. It ends where single leaves
meet. All pairs of a level go in one step of numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

BITS = 64
#: Keeps products like 0.8 * 5 from falling on the wrong side of a whole number.
TINY = 1e-9
#: Node pairs in one step: more are walked in halves, so memory does not grow with their number.
AT_ONCE = 1 << 19


@dataclass(frozen=True)
class Budget:
    """bits: how many two linked fingerprints may differ in. tries: so many tries hold the fingerprints turned by equal
    parts. Of parts that differ in `bits` altogether, one differs in bits // tries at most, so in one of the tries the
    first levels need no larger budget, and every linked pair is met in one of them at least."""

    bits: int
    tries: int = 1

    @property
    def turn(self) -> int:
        return BITS // self.tries

    def at(self, level: int) -> int:
        """Differing bits allowed in paths of so many levels."""
        return self.bits // self.tries if level <= self.turn else self.bits


class Nodes:
    """The nodes below one node, level by level: node k of a level holds the sorted leaves edges[k] to edges[k + 1]."""

    def __init__(self, leaves: np.ndarray, level: int) -> None:
        self.leaves, self.level = leaves, level
        self.edges, self.children = [np.array([0, len(leaves)])], []

    def below(self, level: int) -> np.ndarray:
        """(nodes, 2): the number of each node's 0 child and 1 child one level down, -1 for none."""
        while len(self.children) <= level - self.level:
            edges = self.edges[-1]
            bit = np.uint64(BITS - 1 - self.level - len(self.children))
            zeros = np.concatenate([[0], np.cumsum((self.leaves >> bit) & np.uint64(1) == 0)])
            part = edges[:-1] + zeros[edges[1:]] - zeros[edges[:-1]]
            there = np.stack([part > edges[:-1], edges[1:] > part], axis=1).ravel()
            self.children.append(np.where(there, np.cumsum(there) - 1, -1).astype(np.int32).reshape(-1, 2))
            self.edges.append(np.append(np.stack([edges[:-1], part], axis=1).ravel()[there], len(self.leaves)))
        return self.children[level - self.level]

    def of(self, level: int) -> np.ndarray:
        if level > self.level:
            self.below(level - 1)
        return self.edges[level - self.level]


def walk(left: Nodes, right: Nodes | None, differ: int, budget: Budget, counts: dict[str, int] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places of leaves of the two nodes, and the bits in which they differ, of all pairs that the budget allows.

    right: None for a node paired with itself. differ: the bits in which the two nodes' own paths differ. counts: how
    many node pairs were descended from, pruned, and met as single leaves.
    """
    other = right or left
    first = np.zeros(1, np.int32)
    stack = [(left.level, first, first, np.full(1, differ, np.int8))]
    while stack:
        level, x, y, d = stack.pop()
        if len(x) > AT_ONCE:
            half = len(x) // 2
            stack += [(level, x[:half], y[:half], d[:half]), (level, x[half:], y[half:], d[half:])]
            continue
        a, b = left.of(level), other.of(level)
        alone = (np.diff(a) == 1)[x] & (np.diff(b) == 1)[y]
        if alone.any():
            i, j = a[x[alone]], b[y[alone]]
            bits = np.bitwise_count(left.leaves[i] ^ other.leaves[j])
            near = bits <= budget.bits if right else (bits <= budget.bits) & (i < j)
            if near.any():
                yield i[near], j[near], bits[near]
            if counts is not None:
                counts["met"] += len(i)
            x, y, d = x[~alone], y[~alone], d[~alone]
        if not len(x):
            continue
        down_x, down_y, most = left.below(level)[x], other.below(level)[y], budget.at(level + 1)
        out = []
        for p, q in ((0, 0), (1, 1), (0, 1), (1, 0)):
            there = (down_x[:, p] >= 0) & (down_y[:, q] >= 0)
            if (p, q) == (1, 0) and right is None:
                there &= x != y
            if counts is not None:
                counts["descended"] += int(there.sum())
            if p != q:
                far = d >= most
                if counts is not None:
                    counts["pruned"] += int((there & far).sum())
                there &= ~far
            out.append((down_x[there, p], down_y[there, q], d[there] + np.int8(p != q)))
        stack.append((level + 1, *(np.concatenate(c) for c in zip(*out))))


def parts(left: np.ndarray, right: np.ndarray | None, level: int, differ: int, budget: Budget, most: int) -> Iterator[tuple[int, slice, slice | None, int]]:
    """(level, left's leaves, right's leaves, differ) of the pairs of nodes that the pair of nodes with these sorted leaves
    gives way to, until none has more than `most` leaves; pruned as the walk prunes. None: a node paired with itself."""
    other = left if right is None else right

    def halves(leaves: np.ndarray, low: int, high: int, level: int) -> tuple[tuple[int, int], tuple[int, int]]:
        bit = 1 << (BITS - 1 - level)
        middle = low + int(np.searchsorted(leaves[low:high], np.uint64(int(leaves[low]) & ~(2 * bit - 1) | bit)))
        return (low, middle), (middle, high)

    stack = [(level, (0, len(left)), (0, len(other)), right is None, differ)]
    while stack:
        level, a, b, same, differ = stack.pop()
        if a[1] - a[0] + b[1] - b[0] <= most or level == BITS:
            yield level, slice(*a), None if same else slice(*b), differ
            continue
        down_a, down_b = halves(left, *a, level), halves(other, *b, level)
        for p, q in ((0, 0), (1, 1), (0, 1), (1, 0))[: 3 if same else 4]:
            there = down_a[p][0] < down_a[p][1] and down_b[q][0] < down_b[q][1]
            if there and (p == q or differ + 1 <= budget.at(level + 1)):
                stack.append((level + 1, down_a[p], down_b[q], same and p == q, differ + (p != q)))


class Forest:
    """Joins places step by step, by links that join what was apart: one less than there are places at most."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)

    def apart(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        while not np.array_equal(up := self.root[self.root], self.root):
            self.root = up
        return self.root[i] != self.root[j]

    def join(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which of the links (i, j) join something, given those before."""
        root, kept = self.root.tolist(), []

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for k, (x, y) in enumerate(zip(i.tolist(), j.tolist())):
            x, y = find(x), find(y)
            if x != y:
                root[max(x, y)] = min(x, y)
                kept.append(k)
        self.root = np.array(root)
        return np.array(kept, dtype=np.int64)


class Sets:
    """The shingle sets of a node pair's leaves: the numbers of leaf k's shingles are numbers[at[k]:at[k + 1]]."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.at = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
        self.vocabulary, self.numbers = np.unique(np.concatenate([np.zeros(0, np.int64), *sets]), return_inverse=True)

    def similar(self, i: np.ndarray, j: np.ndarray, share: float) -> np.ndarray:
        """Which pairs have a Jaccard similarity of share or more."""
        out, size = np.zeros(len(i), dtype=bool), np.diff(self.at)
        for k in np.unique(i):
            some = np.flatnonzero(i == k)
            others = j[some]
            held = np.zeros(len(self.vocabulary) + 1, dtype=np.int64)
            held[self.numbers[self.at[k] : self.at[k + 1]]] = 1
            common = np.array([held[self.numbers[self.at[y] : self.at[y + 1]]].sum() for y in others.tolist()])
            out[some] = common >= share * (size[k] + size[others] - common) - TINY
        return out
