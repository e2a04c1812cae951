"""A prefix tree over ordered sets, and the join of a group of sets through it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


class _Node:
    __slots__ = ("children", "docs", "ids", "largest", "mixed", "one", "smallest")

    def __init__(self, ids: np.ndarray, size: int, one: int | None = None):
        self.ids, self.children, self.docs = ids, {}, []
        self.smallest = self.largest = size
        self.one, self.mixed = one, False  # a document here or below, and whether others were apart from it when added


class SetTrie:
    """Sets of ids in one global order, with common beginnings stored once.

    A walk with a probe adds up the overlap along a branch once for all sets below it,
    and leaves a branch when even a full overlap of what remains, in the branch or in
    the probe, could not reach the similarity ``num / den``. It also leaves a branch whose
    documents are all settled.
    """

    def __init__(self, num: int, den: int):
        self._num, self._den = num, den
        self._root = _Node(np.empty(0, dtype=np.int64), 0)

    def need(self, a: int, b: int) -> int:
        """Smallest overlap with overlap * den >= num * union, for set sizes ``a`` and ``b``."""
        return -(-self._num * (a + b) // (self._num + self._den))

    def add(self, ids: np.ndarray, doc: int, settled) -> None:
        """Store a document; ``settled(other)`` says whether ``other`` needs no comparison with it any more."""
        node, size, at = self._root, len(ids), 0
        while at < size:
            child = node.children.get(int(ids[at]))
            if child is None:
                child = node.children[int(ids[at])] = _Node(ids[at:], size, doc)
                child.docs.append(doc)
                return
            n = min(len(child.ids), size - at)
            apart = np.flatnonzero(child.ids[:n] != ids[at : at + n])
            same = int(apart[0]) if len(apart) else n
            if same < len(child.ids):
                upper = _Node(child.ids[:same], size, child.one)
                upper.smallest, upper.largest, upper.mixed = child.smallest, child.largest, child.mixed
                child.ids = child.ids[same:]
                upper.children[int(child.ids[0])] = child
                node.children[int(ids[at])] = child = upper
            child.smallest, child.largest = min(child.smallest, size), max(child.largest, size)
            child.mixed = child.mixed or not settled(child.one)
            node, at = child, at + same
        node.docs.append(doc)

    def similar(self, ids: np.ndarray, mark: np.ndarray, settled) -> Iterator[int]:
        """Documents similar to the probe; ``mark`` is true at its ids, ``settled(doc)`` are skipped.

        ``settled`` may come to hold for more documents while the caller takes what is found. It must be an
        equivalence that only grows, since a branch is left on the word of one of its documents.
        """
        size = len(ids)
        stack = [(child, 0, 0) for child in self._root.children.values()]
        while stack:
            node, depth, overlap = stack.pop()
            if not node.mixed and settled(node.one) or not node.children and all(settled(d) for d in node.docs):
                continue
            low = self.need(size, node.smallest)
            if min(size, node.largest) < low:
                continue
            overlap += int(mark[node.ids].sum())
            depth += len(node.ids)
            if node.docs and overlap >= self.need(size, depth):
                for d in node.docs:
                    if not settled(d):
                        yield d
            if node.children:
                left = size - int(np.searchsorted(ids, node.ids[-1], side="right"))
                if overlap + min(node.largest - depth, left) >= low:
                    stack += [(child, depth, overlap) for child in node.children.values()]


def join_group(sets: list[np.ndarray], labels: list[int], num: int, den: int) -> list[tuple[int, int]]:
    """Links (index, index) that connect all similar sets of the group; sets of equal label count as connected.

    Only links between parts that are not yet connected are returned, fewer than the
    group has sets, and a pair is compared only while its sets are in different parts.
    """
    parent = list(range(len(sets)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    seen: dict[int, int] = {}
    for i, label in enumerate(labels):
        parent[find(i)] = find(seen.setdefault(label, i))
    universe, dense = np.unique(np.concatenate(sets), return_inverse=True) if sets else (np.empty(0), np.empty(0))
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(int)
    local = [dense[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
    trie, mark, links = SetTrie(num, den), np.zeros(len(universe), dtype=bool), []
    for i in sorted(range(len(sets)), key=lambda k: len(sets[k])):
        ids = local[i]
        mark[ids] = True
        root = find(i)
        settled = lambda d, root=root: find(d) == root
        for j in trie.similar(ids, mark, settled):
            links.append((i, j))
            parent[find(j)] = root
        mark[ids] = False
        trie.add(ids, i, settled)
    return links


__all__ = ["SetTrie", "join_group"]
