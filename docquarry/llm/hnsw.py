"""A hierarchical navigable small-world graph over one shard, kept in flat neighbour arrays and searched in batches.

Levels are nested random subsets. A level is built in bulk without comparing all pairs: its nodes are dealt to
overlapping blocks of bounded size around random pivots, candidate links are the nearest within a shared block, the
diversity rule thins them, reverse links fill up to twice the degree. The work of a node depends on the block size, not
on the size of the shard. All lists come from searches: a whole batch of queries moves through the levels together, a
node of the graph itself enters the lowest level at its own place.
"""

from __future__ import annotations

import numpy as np

_STEP, BLOCK, OVERLAP = 512, 2048, 3


def _nearest(x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, cosines) of the k nearest others of every row of one block, nearest first; -1 and -inf where there are fewer."""
    n = len(x)
    ids = np.full((n, k), -1, np.int32)
    sims = np.full((n, k), -np.inf, np.float32)
    w = min(k, n - 1)
    for a in range(0, n if w > 0 else 0, _STEP):
        s = x[a : a + _STEP] @ x.T
        s[np.arange(len(s)), np.arange(a, a + len(s))] = -np.inf
        at = np.argpartition(s, n - w, axis=1)[:, n - w :] if w < n else np.argsort(s, axis=1)
        v = np.take_along_axis(s, at, 1)
        order = np.argsort(-v, axis=1, kind="stable")
        ids[a : a + len(s), :w] = np.take_along_axis(at, order, 1)
        sims[a : a + len(s), :w] = np.take_along_axis(v, order, 1)
    return ids, sims


def _link_candidates(x: np.ndarray, k: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """(ids, cosines) of about the k nearest others of every node, from blocks of at most about ``BLOCK`` nodes.

    Every node belongs to the blocks of its ``OVERLAP`` nearest pivots; a block that comes out too large is cut at random.
    """
    n = len(x)
    if n <= 2 * BLOCK:
        return _nearest(x, k)
    pivots = x[rng.choice(n, -(-OVERLAP * n // BLOCK), replace=False)]
    home = np.empty((n, OVERLAP), np.int64)
    for a in range(0, n, 4096):
        s = x[a : a + 4096] @ pivots.T
        home[a : a + 4096] = np.argpartition(-s, OVERLAP - 1, axis=1)[:, :OVERLAP]
    ids = np.full((n, OVERLAP * k), -1, np.int32)
    sims = np.full((n, OVERLAP * k), -np.inf, np.float32)
    flat = home.T.ravel()
    shuffled = rng.permutation(len(flat))
    order = shuffled[np.argsort(flat[shuffled], kind="stable")]
    cuts = np.flatnonzero(np.diff(flat[order])) + 1
    for block in np.split(order, cuts):
        for part in np.array_split(block, max(1, -(-len(block) // (2 * BLOCK)))):
            nodes, slot = part % n, (part // n) * k
            i, s = _nearest(x[nodes], k)
            at = slot[:, None] + np.arange(k)
            ids[nodes[:, None], at] = np.where(i >= 0, nodes[i], -1)
            sims[nodes[:, None], at] = s
    by_id = np.argsort(ids, axis=1, kind="stable")
    ids, sims = np.take_along_axis(ids, by_id, 1), np.take_along_axis(sims, by_id, 1)
    sims[:, 1:][ids[:, 1:] == ids[:, :-1]] = -np.inf
    best = np.argsort(-sims, axis=1, kind="stable")[:, :k]
    return np.take_along_axis(ids, best, 1), np.take_along_axis(sims, best, 1)


def _linked(x: np.ndarray, ids: np.ndarray, sims: np.ndarray, degree: int) -> np.ndarray:
    """Flat neighbour array (n, 2 * degree): up to ``degree`` diverse links of each node, then links back to it."""
    n, k = ids.shape
    kept = np.zeros((n, k), bool)
    for a in range(0, n, _STEP):
        near = x[np.maximum(ids[a : a + _STEP], 0)]
        among = near @ near.transpose(0, 2, 1)
        own, keep, count = sims[a : a + _STEP], kept[a : a + _STEP], np.zeros(len(near), np.int32)
        for j in range(k):
            blocked = (keep[:, :j] & (among[:, j, :j] > own[:, j : j + 1])).any(axis=1) if j else np.zeros(len(near), bool)
            take = ~blocked & np.isfinite(own[:, j]) & (count < degree)
            keep[:, j] = take
            count += take
        spare = np.isfinite(own) & ~keep  # fill what the rule left free with the nearest of the rest
        room = degree - count
        keep |= spare & (np.cumsum(spare, axis=1) <= room[:, None])
    src, col = np.nonzero(kept)
    dst, s = ids[src, col], sims[src, col]
    out = np.full((n, 2 * degree), -1, np.int32)
    place = np.cumsum(kept, axis=1)[src, col] - 1
    out[src, place] = dst
    order = np.lexsort((-s, dst))
    src, dst = src[order], dst[order]
    rank = np.arange(len(dst)) - np.searchsorted(dst, dst)
    back = rank < degree
    out[dst[back], degree + rank[back]] = src[back]
    return out


class Graph:
    def __init__(self, x: np.ndarray, degree: int = 12, seed: int = 1):
        """x: rows of unit length."""
        self.x = x
        rng = np.random.default_rng(seed)
        self.levels = []
        nodes = np.arange(len(x))
        while True:
            part = x if len(nodes) == len(x) else x[nodes]
            ids, sims = _link_candidates(part, 2 * degree, rng)
            self.levels.append((nodes, _linked(part, ids, sims, degree)))
            if len(nodes) <= 4 * degree:
                break
            nodes = np.sort(rng.choice(nodes, max(1, len(nodes) // degree), replace=False))

    def search(self, q: np.ndarray, k: int, ef: int = 32) -> tuple[np.ndarray, np.ndarray]:
        """(ids, cosines) of about the k nearest nodes of every query, nearest first."""
        return self._batched(q, None, k, ef)

    def search_members(self, k: int, ef: int = 32) -> tuple[np.ndarray, np.ndarray]:
        """The same for every node of the graph, itself left out; each search enters at the node's own place."""
        ids, sims = self._batched(self.x, np.arange(len(self.x)), k + 1, ef + 1)
        own = ids == np.arange(len(ids))[:, None]
        own[:, -1] |= ~own.any(axis=1)
        return ids[~own].reshape(len(ids), k), sims[~own].reshape(len(ids), k)

    def _batched(self, q: np.ndarray, places: np.ndarray | None, k: int, ef: int) -> tuple[np.ndarray, np.ndarray]:
        ids = np.full((len(q), k), -1, np.int32)
        sims = np.full((len(q), k), -np.inf, np.float32)
        size = max(64, min(1024, (1 << 24) // max(1, len(self.x))))  # bounds the table of visited nodes
        for a in range(0, len(q), size):
            part = q[a : a + size]
            start = self._descend(part) if places is None else places[a : a + size, None]
            i, s = self._beam(self.x, self.levels[0][1], part, start, max(ef, k))
            ids[a : a + size], sims[a : a + size] = i[:, :k], s[:, :k]
        return ids, sims

    def _descend(self, q: np.ndarray) -> np.ndarray:
        """Entry points of the lowest level, from a search of each level above it."""
        top = self.levels[-1][0]
        s = q @ self.x[top].T  # the top level is small enough to be looked at as a whole
        start = top[np.argsort(-s, axis=1)[:, : min(4, len(top))]]
        for nodes, links in self.levels[-2:0:-1]:
            back = np.full(len(self.x), -1, np.int32)
            back[nodes] = np.arange(len(nodes))
            i, _ = self._beam(self.x[nodes], links, q, back[start], 8)
            start = np.where(i[:, :4] >= 0, nodes[i[:, :4]], start[:, :1])
        return start

    @staticmethod
    def _beam(x: np.ndarray, links: np.ndarray, q: np.ndarray, start: np.ndarray, ef: int, wide: int = 4) -> tuple[np.ndarray, np.ndarray]:
        """Best-first search of all queries at once; each step opens the ``wide`` best unopened nodes of every query."""
        n = len(q)
        rows = np.arange(n)
        seen = np.zeros((n, len(x) + 1), bool)
        seen[:, -1] = True  # the place of -1
        ids = np.full((n, ef), -1, np.int32)
        sims = np.full((n, ef), -np.inf, np.float32)
        opened = np.ones((n, ef), bool)

        def admit(who: np.ndarray, new: np.ndarray) -> None:
            new = np.sort(new, axis=1)
            fresh = ~seen[who[:, None], new]
            fresh[:, 1:] &= new[:, 1:] != new[:, :-1]
            r, c = np.nonzero(fresh)
            if not len(r):
                return
            node, query = new[r, c], who[r]
            seen[query, node] = True
            s = np.einsum("ij,ij->i", x[node], q[query])
            good = s > sims[query, -1]  # only what beats the worst of a full list
            r, node, s = r[good], node[good], s[good]
            if not len(r):
                return
            count = np.bincount(r, minlength=len(who))
            some = np.flatnonzero(count)
            at = np.arange(len(r)) - np.repeat(np.cumsum(count[some]) - count[some], count[some])
            row = np.repeat(np.arange(len(some)), count[some])
            wide_ids = np.full((len(some), int(count.max())), -1, np.int32)
            wide_sims = np.full(wide_ids.shape, -np.inf, np.float32)
            wide_ids[row, at], wide_sims[row, at] = node, s
            mine = who[some]
            every = np.concatenate([sims[mine], wide_sims], axis=1)
            order = np.argsort(-every, axis=1, kind="stable")[:, :ef]
            sims[mine] = np.take_along_axis(every, order, 1)
            ids[mine] = np.take_along_axis(np.concatenate([ids[mine], wide_ids], axis=1), order, 1)
            opened[mine] = np.take_along_axis(np.concatenate([opened[mine], ~np.isfinite(wide_sims)], axis=1), order, 1)

        admit(rows, start.astype(np.int32))
        who = rows
        while len(who):
            who = who[~opened[who].all(axis=1)]
            if not len(who):
                break
            first = np.argsort(opened[who], axis=1, kind="stable")[:, :wide]
            fresh = ~np.take_along_axis(opened[who], first, 1)
            node = np.where(fresh, np.take_along_axis(ids[who], first, 1), -1)
            mark = opened[who]
            np.put_along_axis(mark, first, True, 1)
            opened[who] = mark
            admit(who, np.where(node[:, :, None] >= 0, links[node], -1).reshape(len(who), -1))
        ids[~np.isfinite(sims)] = -1
        return ids, sims
