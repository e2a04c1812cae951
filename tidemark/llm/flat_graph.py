"""A flat neighbour graph over unit vectors: robust pruning, greedy walks, range expansion.

Everything works on many vectors at a time, so the cost is that of array operations.
Distances are squared chords, ``2 - 2 * cosine``.
"""

from __future__ import annotations

import numpy as np

DEGREE = 32
BEAM = 80
ALPHA = 1.1
BATCH = 256
_UNSEEN = -2.0


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; the largest entry is scaled first, so squares stay finite."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def medoid(x: np.ndarray) -> int:
    """The vector nearest to the mean direction."""
    return int(np.argmax(x @ x.mean(axis=0)))


def _pair_cosines(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.empty(len(a))
    for i in range(0, len(a), 1 << 15):
        out[i : i + (1 << 15)] = np.einsum("ij,ij->i", x[a[i : i + (1 << 15)]], x[b[i : i + (1 << 15)]])
    return out


def walk(x: np.ndarray, near: np.ndarray, queries: np.ndarray, starts: np.ndarray, beam: int) -> np.ndarray:
    """Greedy best-first walks of a batch; cosines of the vectors each query has seen, else _UNSEEN.

    ``near`` lists neighbours, -1 where there are fewer. ``starts`` has the places where each query
    begins, -1 for none. A walk ends when its ``beam`` best vectors have been expanded.
    """
    n = len(queries)
    seen = np.full((n, len(x)), _UNSEEN)
    rows = np.arange(n)

    def look(who: np.ndarray, what: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Unseen targets of queries, as (places, cosines) padded by -1."""
        fresh = what >= 0
        fresh[fresh] = seen[np.broadcast_to(who[:, None], what.shape)[fresh], what[fresh]] == _UNSEEN
        a, column = np.nonzero(fresh)
        targets = what[a, column]
        cos = _pair_cosines(x, queries[who[a]], targets)
        seen[who[a], targets] = cos
        sims = np.full(what.shape, _UNSEEN)
        sims[a, column] = cos
        return np.where(fresh, what, -1), sims

    ids, sims = look(rows, starts.copy())
    width = beam + near.shape[1]
    pool = np.full((n, max(width, starts.shape[1])), -1, dtype=np.int64)
    score = np.full(pool.shape, _UNSEEN)
    done = np.zeros(pool.shape, dtype=bool)
    pool[:, : ids.shape[1]], score[:, : ids.shape[1]] = ids, sims
    active = rows
    while len(active):
        order = np.argsort(-score[active], axis=1, kind="stable")
        at = active[:, None]
        pool[active], score[active], done[active] = pool[at, order], score[at, order], done[at, order]
        waiting = ~done[active, :beam] & (score[active, :beam] > _UNSEEN)
        going = waiting.any(axis=1)
        active, first = active[going], waiting[going].argmax(axis=1)
        if not len(active):
            break
        done[active, first] = True
        ids, sims = look(active, near[pool[active, first]])
        # Places behind the beam are never expanded, so they take the new arrivals.
        pool[active, beam:width], score[active, beam:width], done[active, beam:width] = ids, sims, False
    return seen


def prune(x: np.ndarray, points: np.ndarray, candidates: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA) -> np.ndarray:
    """Neighbours of each point: the nearest candidate stays, others that are much nearer to it than to the point go, and so on."""
    n, width = candidates.shape
    known = candidates >= 0
    sims = np.einsum("id,icd->ic", x[points], x[candidates])
    sims[~known] = _UNSEEN
    order = np.argsort(-sims, axis=1, kind="stable")
    rows = np.arange(n)[:, None]
    candidates, sims, alive = candidates[rows, order], sims[rows, order], known[rows, order]
    vectors, away = x[candidates], 2 - 2 * sims
    out = np.full((n, degree), -1, dtype=np.int64)
    for k in range(degree):
        left = alive.any(axis=1)
        if not left.any():
            break
        pick = alive.argmax(axis=1)
        out[left, k] = candidates[left, pick[left]]
        between = 2 - 2 * np.einsum("id,icd->ic", vectors[np.arange(n), pick], vectors)
        alive &= alpha * alpha * between > away
        alive[np.arange(n), pick] = False
    return out


def _with_reverse(x: np.ndarray, near: np.ndarray, points: np.ndarray) -> None:
    """Give the neighbours of ``points`` an edge back; lists that overflow are pruned."""
    degree = near.shape[1]
    a, k = np.nonzero(near[points] >= 0)
    source, target = points[a], near[points][a, k]
    cos = _pair_cosines(x, source, target)
    order = np.lexsort((-cos, target))
    source, target = source[order], target[order]
    heads, first, count = np.unique(target, return_index=True, return_counts=True)
    for some in range(0, len(heads), BATCH):
        own, begin, many = heads[some : some + BATCH], first[some : some + BATCH], np.minimum(count[some : some + BATCH], degree)
        fresh = np.full((len(own), degree), -1, dtype=np.int64)
        place = np.arange(degree)[None, :] < many[:, None]
        fresh[place] = source[(begin[:, None] + np.arange(degree))[place]]
        fresh[(fresh[:, :, None] == near[own][:, None, :]).any(axis=2)] = -1
        near[own] = prune(x, own, np.concatenate([near[own], fresh], axis=1), degree)


def build(x: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA) -> np.ndarray:
    """Neighbour lists of unit vectors, grown by batches that double in size up to BATCH.

    Each newcomer walks the graph so far from the medoid; what it has seen and its own batch are pruned to its neighbours.
    """
    n = len(x)
    near = np.full((n, degree), -1, dtype=np.int64)
    start = medoid(x)
    order = np.random.default_rng(n).permutation(n)
    order = np.concatenate([[start], order[order != start]])
    at, size = 1, 1
    while at < n:
        fresh = order[at : at + size]
        seen = walk(x, near, fresh, np.full((len(fresh), 1), start), beam)
        seen[:, fresh] = x[fresh] @ x[fresh].T
        seen[np.arange(len(fresh)), fresh] = _UNSEEN
        most = min(2 * beam, n)
        best = np.argpartition(-seen, most - 1, axis=1)[:, :most]
        best[np.take_along_axis(seen, best, axis=1) == _UNSEEN] = -1
        near[fresh] = prune(x, fresh, best, degree, alpha)
        _with_reverse(x, near, fresh)
        at, size = at + len(fresh), min(2 * size, BATCH)
    return near


def undirected(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Neighbours in either direction: where each place's begin (one more at the end), and the list."""
    a, k = np.nonzero(near >= 0)
    b = near[a, k]
    pairs = np.unique(np.concatenate([a * len(near) + b, b * len(near) + a]))
    return np.searchsorted(pairs, np.arange(len(near) + 1) * len(near)), pairs % len(near)


def in_range(
    x: np.ndarray, near: np.ndarray, both: tuple[np.ndarray, np.ndarray], queries: np.ndarray, start: int, threshold: float,
    beam: int = BEAM,
) -> np.ndarray:
    """For each query (a place in the graph) the vectors found with a cosine of at least ``threshold``, as booleans.

    A walk from the medoid and the query's own place along ``near``; then whatever lies within a somewhat wider
    angle is expanded too, along ``both`` (``undirected``), until nothing new turns up there. In a dense
    group some vectors are nobody's neighbour; edges against their direction reach them.
    """
    wide = float(np.cos(min(1.25 * np.arccos(threshold), np.pi)))
    starts = np.stack([np.full(len(queries), start), queries], axis=1)
    starts[starts[:, 0] == starts[:, 1], 1] = -1
    seen = walk(x, near, queries, starts, beam)
    expanded = np.zeros(seen.shape, dtype=bool)
    begin, others = both
    degree = np.diff(begin)
    while True:
        who, what = np.nonzero((seen >= wide) & ~expanded)
        if not len(who):
            return seen >= threshold
        expanded[who, what] = True
        # As many places at a time as have about 2**18 neighbours.
        turn = np.cumsum(degree[what]) >> 18
        for i, j in zip(*_runs(turn)):
            d = degree[what[i:j]]
            a = np.repeat(who[i:j], d)
            b = others[np.repeat(begin[what[i:j]] - (np.cumsum(d) - d), d) + np.arange(len(a))]
            fresh = seen[a, b] == _UNSEEN
            pairs = np.unique(a[fresh] * len(x) + b[fresh])
            a, b = pairs // len(x), pairs % len(x)
            seen[a, b] = _pair_cosines(x, queries[a], b)


def _runs(values: np.ndarray) -> tuple[list[int], list[int]]:
    """First and last places (exclusive) of the runs of equal values."""
    cuts = (np.flatnonzero(np.diff(values)) + 1).tolist()
    return [0, *cuts], [*cuts, len(values)]
