"""A signature tree over sets of 64-bit tokens, and the dual traversal that finds pairs of similar sets.

A leaf holds a few sets, a node up to eight children. Each has the OR of its sets' token bitmaps, the range of their sizes and the
largest number of tokens that share a bit with another token of the same set. Tokens that x of one node and y of
another have in common lie on bits which both nodes have, so there are at most as many as common bits plus that surplus.
A pair of nodes whose bound is too small, or whose size ranges don't fit, is left out with all pairs below it.
"""

from __future__ import annotations

import numpy as np

LEAF, FAN = 8, 8


class Union:
    """Union-find over 0..n-1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def link(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


class Node:
    __slots__ = ("kids", "most", "least", "or_", "surplus", "items", "root")


def enough(common: int, a: int, b: int, num: int, den: int) -> bool:
    """den * intersection >= num * union, for sets of sizes a and b."""
    return den * common >= num * (a + b - common)


def overlap(x: np.ndarray, y: np.ndarray) -> int:
    """Common tokens of two sorted arrays of distinct tokens."""
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int((y[at] == x).sum()) if len(y) else 0


class Tree:
    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        width = 64
        while width < 2 * int(self.sizes.max(initial=1)) and width < 1 << 15:
            width *= 2
        self.bits = np.zeros((len(sets), width // 64), dtype=np.uint64)
        for k, s in enumerate(sets):
            on = np.zeros(width, dtype=bool)
            on[(s % np.uint64(width)).astype(np.int64)] = True
            self.bits[k] = np.packbits(on).view(np.uint64)
        self.surplus = self.sizes - np.bitwise_count(self.bits).sum(axis=1).astype(np.int64)

    def build(self, items: np.ndarray) -> Node:
        """Sets of like size side by side, and among them those with like smallest tokens."""
        level = np.floor(np.log(np.maximum(self.sizes[items], 1)) / np.log(1.1))
        smallest = np.array([self.sets[i][0] if len(self.sets[i]) else 0 for i in items.tolist()], dtype=np.uint64)
        items = items[np.lexsort((items, smallest, level))]
        nodes = [self._node(items[k : k + LEAF], None) for k in range(0, len(items), LEAF)]
        while len(nodes) > 1:
            nodes = [self._node(None, nodes[k : k + FAN]) for k in range(0, len(nodes), FAN)]
        return nodes[0]

    def _node(self, items, kids) -> Node:
        n = Node()
        n.items, n.kids, n.root = items, kids, None
        if kids is None:
            n.or_ = np.bitwise_or.reduce(self.bits[items], axis=0)
            n.least, n.most, n.surplus = int(self.sizes[items].min()), int(self.sizes[items].max()), int(self.surplus[items].max())
        else:
            n.or_ = np.bitwise_or.reduce([k.or_ for k in kids], axis=0)
            n.least, n.most, n.surplus = min(k.least for k in kids), max(k.most for k in kids), max(k.surplus for k in kids)
        return n


def joined(sets: list[np.ndarray], known: Union, left: np.ndarray, right: np.ndarray | None, num: int = 80, den: int = 100) -> None:
    """Join in ``known`` all similar sets of ``left`` x ``right`` (of ``left`` with itself, for None).

    Pairs that are connected already needn't be compared: they change no component.
    """
    tree = Tree(sets)
    a = tree.build(left)
    b = a if right is None else tree.build(right)

    def same_root(n: Node):
        """The one component that all sets of a node are in, or None; components found meanwhile only add to this."""
        if n.root is None:
            roots = {same_root(k) for k in n.kids} if n.kids else {known.find(i) for i in n.items.tolist()}
            n.root = roots.pop() if len(roots) == 1 and None not in roots else -1
        return known.find(n.root) if n.root >= 0 else None

    def possible(x: Node, y: Node) -> bool:
        if den * min(x.most, y.most) < num * max(x.least, y.least):
            return False
        most = min(x.most, y.most, min(x.surplus, y.surplus) + int(np.bitwise_count(x.or_ & y.or_).sum()))
        return enough(most, x.least, y.least, num, den)

    waiting = [(a, b)]
    while waiting:
        x, y = waiting.pop()
        rx = same_root(x)
        if (rx is not None and rx == same_root(y)) or not possible(x, y):
            continue
        if x.kids and (y.kids is None or len(x.kids) >= 1):
            if x is y:
                waiting += [(p, q) for k, p in enumerate(x.kids) for q in x.kids[k:]]
            else:
                waiting += [(p, y) for p in x.kids] if y.kids is None else [(p, q) for p in x.kids for q in y.kids]
        elif y.kids:
            waiting += [(x, q) for q in y.kids]
        else:
            for i in x.items.tolist():
                for j in y.items.tolist():
                    if (x is y and j <= i) or i == j or known.find(i) == known.find(j):
                        continue
                    s, t = int(tree.sizes[i]), int(tree.sizes[j])
                    if den * min(s, t) < num * max(s, t):
                        continue
                    both = int(np.bitwise_count(tree.bits[i] & tree.bits[j]).sum())
                    if enough(min(s, t, both + int(min(tree.surplus[i], tree.surplus[j]))), s, t, num, den) and enough(overlap(sets[i], sets[j]), s, t, num, den):
                        known.link(i, j)
