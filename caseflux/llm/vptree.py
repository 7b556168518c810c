"""Vantage-point trees over parity fingerprints in Hamming space.

``range_pairs`` answers the range queries of a shard: its members are put in
order of length and each stretch of lengths gets a tree; whole sets of queries
descend it together, a branch is left out for a query when the triangle
inequality puts it beyond the query's radius, leaves are compared in full.
"""

from __future__ import annotations

import numpy as np

LEAF = 32
#: Members of a leaf and of a tree in shards above LEAF; fingerprints compared at once.
WIDE_LEAF, STRETCH, AT_ONCE = 256, 2048, 1 << 16
#: Bits by which the distances to a vantage point must part for the cut to follow the gap.
GAP = 12


def limit_ratio(t: float) -> float:
    """Jaccard >= t implies |A xor B| <= ratio * (|A| + |B|)."""
    return (1 - t) / (1 + t)


def hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int32)


class VPTree:
    """Nodes hold a vantage point, the distances that part its two branches, and the branches.

    The cut lies in the widest gap of the distances, so that a cluster around
    the vantage point comes off whole and the triangle inequality can leave
    either side out; without a gap it lies at the median.
    """

    def __init__(self, fp: np.ndarray, leaf: int = LEAF):
        self.fp, self.leaf = fp, leaf
        self.nodes: list[tuple] = []
        self.compared = 0
        self.root = 0
        todo: list[tuple[np.ndarray, int, int]] = [(np.arange(len(fp)), -1, 0)]
        while todo:
            ids, parent, side = todo.pop()
            at = len(self.nodes)
            if parent >= 0:
                self.nodes[parent][5 + side] = at
            split = self._split(ids) if len(ids) > leaf else None
            if split is None:
                self.nodes.append(("leaf", ids))
                continue
            vp, d, mu, rest = split
            near = d <= mu
            self.nodes.append(["node", vp, mu, int(d[near].min()), int(d[~near].min()), -1, -1, int(d[~near].max())])
            todo += [(rest[near], at, 0), (rest[~near], at, 1)]

    def _split(self, ids: np.ndarray):
        vp, rest = ids[0], ids[1:]
        d = hamming(self.fp[rest], self.fp[vp])
        self.compared += len(rest)
        ordered = np.sort(d)
        if ordered[0] == ordered[-1]:  # all equally far: no bound can part them
            return None
        gaps = np.diff(ordered)
        at = int(gaps.argmax())
        mu = int(ordered[at]) if gaps[at] >= GAP else int(np.median(d))
        return vp, d, mu if mu < ordered[-1] else int(ordered[-1]) - 1, rest

    def query(self, q: np.ndarray, radius: np.ndarray):
        """Yields (query index, member index, distance) arrays within the radii."""
        cols = np.ascontiguousarray(q.T)
        stack = [(self.root, np.arange(len(q)))]
        while stack:
            at, qs = stack.pop()
            node = self.nodes[at]
            if node[0] == "leaf":
                ids = node[1]
                own = np.ascontiguousarray(self.fp[ids].T)
                step = max(1, AT_ONCE // max(1, len(ids)))
                apart = np.empty((min(step, len(qs)), len(ids)), np.uint64)
                bits, more = np.empty(apart.shape, np.uint8), np.empty(apart.shape, np.uint8)
                for s in range(0, len(qs), step):
                    part = qs[s : s + step]
                    x, d, c = apart[: len(part)], bits[: len(part)], more[: len(part)]
                    for k in range(3):  # three words first: they hold no more than 192 bits and sort out most
                        np.bitwise_xor(cols[k][part][:, None], own[k][None, :], out=x)
                        np.bitwise_count(x, out=c if k else d)
                        if k:
                            d += c
                    self.compared += d.size
                    near = np.flatnonzero(d <= np.minimum(radius[part], 255).astype(np.uint8)[:, None])
                    if len(near):
                        i, j = near // len(ids), near % len(ids)
                        far = d.ravel()[near].astype(np.int32) + np.bitwise_count(cols[3][part[i]] ^ own[3][j])
                        ok = far <= radius[part[i]]
                        if ok.any():
                            yield part[i[ok]], ids[j[ok]], far[ok]
                continue
            _, vp, mu, low, least, a, b, high = node
            d = hamming(q[qs], self.fp[vp])
            self.compared += len(qs)
            r = radius[qs]
            hit = d <= r
            if hit.any():
                yield qs[hit], np.full(int(hit.sum()), vp), d[hit]
            # members of the near branch lie low..mu from the vantage point, those of the far one least..high
            inner = (d - r <= mu) & (d + r >= low)
            outer = (d + r >= least) & (d - r <= high)
            if inner.any():
                stack.append((a, qs[inner]))
            if outer.any():
                stack.append((b, qs[outer]))


def _keep(i, j, d, size, ratio):
    ok = d <= ratio * (size[i] + size[j]) + 1e-9
    return i[ok], j[ok]


def range_pairs(fp: np.ndarray, size: np.ndarray, most: np.ndarray, t: float, side: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs whose fingerprints are as near as Jaccard >= t demands.

    ``most``: the longest partner a member can have in this shard; only pairs
    within each other's bound are asked for, others may be given as well.
    ``side``: if given, only pairs of one member of side 1 and one of side 2.
    """
    if side is not None:
        outs = [_stretches(fp, size, most, t, np.flatnonzero(side == a), np.flatnonzero(side == b)) for a, b in ((1, 2), (2, 1))]
    else:
        every = np.arange(len(fp))
        outs = [_stretches(fp, size, most, t, every, every)]
    return tuple(np.concatenate([np.zeros(0, np.int64), *(x for o in outs for x in o[k::2])]) for k in (0, 1))


def _stretches(fp, size, most, t, asking, members) -> list[np.ndarray]:
    """Asking and member indices, in turn, of the pairs in which the member takes partners of its own length.

    Of two within each other's bound one at least does; where both do, the shorter asks.
    """
    ratio = limit_ratio(t)
    asking = asking[np.lexsort((asking, size[asking]))]
    members = members[most[members] >= size[members]]
    members = members[np.lexsort((members, size[members]))]
    peer = most[asking] >= size[asking]
    outs: list[np.ndarray] = []
    for at in range(0, len(members), STRETCH):
        part = members[at : at + STRETCH]
        low, high = size[part[0]], size[part[-1]]
        wanted = (most[asking] >= low) & (size[asking] <= np.where(peer, high, most[part].max()))
        q = asking[wanted]
        if not len(q):
            continue
        tree = VPTree(fp[part], WIDE_LEAF)
        radius = np.floor(ratio * (size[q] + high) + 1e-9).astype(np.int32)
        for qi, mi, d in tree.query(fp[q], radius):
            i, j = q[qi], part[mi]
            # two peers meet once: the shorter asks, of equals the first
            once = (most[i] < size[i]) | (size[i] < size[j]) | ((size[i] == size[j]) & (i < j))
            outs += _keep(i[once], j[once], d[once], size, ratio)
    return outs


def small_shard_pairs(fp: np.ndarray, size: np.ndarray, starts: np.ndarray, counts: np.ndarray, t: float):
    """range_pairs for many shards of at most LEAF members, by shard size."""
    ratio = limit_ratio(t)
    for m in np.unique(counts):
        if m < 2 or m > LEAF:
            continue
        at = starts[counts == m]
        i, j = np.triu_indices(int(m), 1)
        step = max(1, 200_000 // len(i))
        for s in range(0, len(at), step):
            a = (at[s : s + step, None] + i[None, :]).ravel()
            b = (at[s : s + step, None] + j[None, :]).ravel()
            yield _keep(a, b, hamming(fp[a], fp[b]), size, ratio)
