"""Links between shingle sets by dual traversal of signature trees."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

LEAF = 32
LEAST_BITS, MOST_BITS = 1 << 8, 1 << 15


@dataclass(frozen=True)
class Node:
    """Sets below the node: OR of their bitmaps, range of sizes, and the most shingles
    that share a bit with another one of the same set."""

    docs: np.ndarray
    bits: np.ndarray
    least: int
    most: int
    shared: int
    parts: tuple[Node, Node] | None
    tokens: np.ndarray | None = None
    starts: np.ndarray | None = None


class LinkFinder:
    """Joins classes of sets that hold linked sets: 7 * overlap >= 3 * (size + size),
    which is a Jaccard similarity of three quarters or more."""

    def __init__(self, sets: list[np.ndarray], labels: np.ndarray):
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        every = np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64)
        known, self.tokens = np.unique(every, return_inverse=True)
        self.mark = np.zeros(len(known), dtype=np.int32)
        self.first = np.array([s[0] for s in sets], dtype=np.uint64)
        self.labels, self.label_of = np.unique(labels, return_inverse=True)
        self.root = np.arange(len(self.labels))
        most = max(int(self.sizes.max(initial=1)), 1)
        width = min(max(LEAST_BITS, 1 << (4 * most - 1).bit_length()), MOST_BITS)
        self.bitmaps = np.zeros((len(sets), width // 8), dtype=np.uint8)
        for i, s in enumerate(sets):
            flags = np.zeros(width, dtype=bool)
            flags[(s & np.uint64(width - 1)).astype(np.int64)] = True
            self.bitmaps[i] = np.packbits(flags)
        self.bitmaps = self.bitmaps.view(np.uint64)
        self.shared = self.sizes - np.bitwise_count(self.bitmaps).sum(axis=1)

    def tree(self, docs: np.ndarray) -> Node:
        """A tree over the sets numbered `docs`, those with the same least hash close."""
        return self._node(docs[np.lexsort((self.sizes[docs], self.first[docs]))])

    def _node(self, docs: np.ndarray) -> Node:
        if len(docs) > LEAF:
            half = len(docs) // 2
            low, high = self._node(docs[:half]), self._node(docs[half:])
            return Node(
                docs, low.bits | high.bits, min(low.least, high.least),
                max(low.most, high.most), max(low.shared, high.shared), (low, high),
            )
        sizes = self.sizes[docs]
        tokens = [self.tokens[self.starts[d] : self.starts[d + 1]] for d in docs]
        return Node(
            docs, np.bitwise_or.reduce(self.bitmaps[docs], axis=0), int(sizes.min()),
            int(sizes.max()), int(self.shared[docs].max()), None,
            np.concatenate(tokens), np.concatenate([[0], np.cumsum(sizes)[:-1]]),
        )

    def roots(self, docs: np.ndarray) -> np.ndarray:
        return self.root[self.label_of[docs]]

    def _hopeless(self, a: Node, b: Node) -> bool:
        """Whether no set of `a` can bring news of a set of `b`."""
        if 4 * a.most < 3 * b.least or 4 * b.most < 3 * a.least:
            return True
        common = int(np.bitwise_count(a.bits & b.bits).sum())
        # A shared shingle has a shared bit. Those over share a bit within each set.
        if 7 * (common + min(a.shared, b.shared)) < 3 * (a.least + b.least):
            return True
        ours, theirs = self.roots(a.docs), self.roots(b.docs)
        return bool((ours == ours[0]).all() and (theirs == ours[0]).all())

    def join(self, a: Node, b: Node) -> None:
        """Find every pair of linked sets whose classes are not joined yet."""
        pending = [(a, b)]
        while pending:
            a, b = pending.pop()
            if self._hopeless(a, b):
                continue
            if a is b and a.parts:
                low, high = a.parts
                pending += [(low, high), (high, high), (low, low)]
            elif a.parts and (not b.parts or len(a.docs) >= len(b.docs)):
                pending += [(part, b) for part in a.parts]
            elif b.parts:
                pending += [(a, part) for part in b.parts]
            else:
                self._verify(a, b)

    def _verify(self, a: Node, b: Node) -> None:
        sizes = self.sizes[b.docs]
        for doc in a.docs:
            own, n = self.root[self.label_of[doc]], self.sizes[doc]
            other = self.roots(b.docs) != own
            if not (other & (4 * sizes >= 3 * n) & (4 * n >= 3 * sizes)).any():
                continue
            mine = self.tokens[self.starts[doc] : self.starts[doc + 1]]
            self.mark[mine] = 1
            overlap = np.add.reduceat(self.mark[b.tokens], b.starts)
            self.mark[mine] = 0
            for near in b.docs[other & (7 * overlap >= 3 * (n + sizes))]:
                self._unite(self.label_of[doc], self.label_of[near])

    def _unite(self, x: int, y: int) -> None:
        low, high = sorted((self.root[x], self.root[y]))
        if low != high:
            self.root[self.root == high] = low

    def joined(self) -> tuple[np.ndarray, np.ndarray]:
        """Labels that are no longer their own class, and the least label of each."""
        gone = np.flatnonzero(self.root != np.arange(len(self.root)))
        return self.labels[gone], self.labels[self.root[gone]]


def links_within(sets: list[np.ndarray], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Joined labels (greater, least) of non-empty sets compared with one another."""
    finder = LinkFinder(sets, labels)
    tree = finder.tree(np.arange(len(sets)))
    finder.join(tree, tree)
    return finder.joined()


def links_between(
    sets: list[np.ndarray], labels: np.ndarray, left: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The same for sets where `left` is true compared with those where it is not."""
    finder = LinkFinder(sets, labels)
    sides = np.flatnonzero(left), np.flatnonzero(~left)
    if len(sides[0]) and len(sides[1]):
        finder.join(*map(finder.tree, sides))
    return finder.joined()
