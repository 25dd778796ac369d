"""One regression tree over rows that fit a task: exact splits, all nodes of a level together.

Rows stand in one order per feature, by node and then by value. On each level
the sums left of every row give every possible split's gain at once, for all
nodes; a stable partition of the orders makes the next level. So a tree costs
a few array passes per level and feature, however many nodes a level has.

Labels come as whole numbers held in doubles, small enough that no sum loses a
bit. The order of rows then changes nothing: the same rows give the same
tree however they were laid out, here and in the level histograms.

Of splits with equal gain the first feature's and then the lowest value's is
taken; a cut lies half way between neighbouring values. A node is split while
its labels differ and a feature does. ``max_features`` are drawn by hash of
node and feature among those that differ inside the node.
"""

from __future__ import annotations

import numpy as np

#: Multipliers of a 32-bit mixing function, and what tells left from right children.
MIX = (0x7FEB352D, 0x846CA68B)
SIDES = (0x9E3779B9, 0x85EBCA6B)
LEAF = -1
#: Poisson(1) up to 12 draws: the chance of more is below 2^-32.
POISSON_CDF = np.cumsum([np.exp(-1.0) / f for f in np.cumprod([1.0, *range(1, 12)])])


def mix32(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(16))) * np.uint64(MIX[0]) & np.uint64(0xFFFFFFFF)
    x = (x ^ (x >> np.uint64(15))) * np.uint64(MIX[1]) & np.uint64(0xFFFFFFFF)
    return x ^ (x >> np.uint64(16))


def tree_hash(seed: int, number: int) -> int:
    """Of a tree by its forest's seed and its place: the same for all candidates of a search."""
    return int(mix32(int(mix32(seed & 0xFFFFFFFF)) ^ number))


def child_hash(node: np.ndarray, side: int) -> np.ndarray:
    return mix32(np.asarray(node, np.uint64) ^ np.uint64(SIDES[side]))


def bag_weights(key_hash: np.ndarray, tree: int) -> np.ndarray:
    """Copies of each row in a bootstrapped tree: Poisson with mean 1, by hash of row and tree."""
    u = mix32(key_hash.astype(np.uint64) ^ mix32(np.uint64(tree))) / np.float64(1 << 32)
    return np.searchsorted(POISSON_CDF, u, "right").astype(np.float64)


def drawn(node: np.ndarray, differs: np.ndarray, m: int) -> np.ndarray:
    """Which features each node may split by: the ``m`` of least hash among those that differ in it."""
    p = differs.shape[1]
    if m >= p:
        return differs
    order = mix32(node[:, None] ^ mix32(np.arange(1, p + 1, dtype=np.uint64))[None, :]).astype(np.float64)
    order = np.where(differs, order, np.inf)
    last = np.partition(order, m - 1, axis=1)[:, m - 1]
    return differs & (order <= last[:, None])


class Tree:
    """Nodes as arrays: ``feature`` (or LEAF), ``value`` (cut, or a leaf's prediction), ``left`` (the right child is the next)."""

    def __init__(self, feature: np.ndarray, value: np.ndarray, left: np.ndarray) -> None:
        self.feature, self.value, self.left = feature, value, left

    def nodes_of(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every row; ``x`` by feature, then row. A value at the cut goes left."""
        n = x.shape[1]
        at, flat = np.zeros(n, np.int64), np.ascontiguousarray(x).reshape(-1)
        rows, here = np.arange(n), np.zeros(n, np.int64)
        while len(rows):
            f = self.feature[here]
            on = f != LEAF
            if not on.all():
                at[rows[~on]] = here[~on]
                rows, here, f = rows[on], here[on], f[on]
            here = self.left[here] + (flat[f * np.int64(n) + rows] > self.value[here])
        return at

    def predict(self, x: np.ndarray) -> np.ndarray:
        return self.value[self.nodes_of(x)]


class Orders:
    """Rows ordered by each feature, and their values' dense ranks: computed once for all trees over the same rows."""

    def __init__(self, x: np.ndarray) -> None:
        self.x = x
        self.order = [np.argsort(v, kind="stable").astype(np.int32) for v in x]
        self.rank = []
        for v, o in zip(x, self.order, strict=True):
            s = v[o]
            rank = np.empty(len(v), np.int32)
            rank[o] = np.cumsum(np.append(0, s[1:] != s[:-1])) if len(v) else 0
            self.rank.append(rank)


def grow(orders: Orders, y: np.ndarray, weight: np.ndarray, max_features: int, node: int, max_depth: int | None = None, min_leaf: float = 1) -> Tree:
    """The tree of the rows with a weight above 0; ``node``: hash of the root, ``max_depth``: levels left below it."""
    x, p = orders.x, len(orders.x)
    ws, used = weight * y, weight > 0
    plain = bool((weight[used] == 1).all())  # sums of weights are then counts
    order = [o[used[o]] for o in orders.order]
    feature, value, left = [np.array([LEAF], np.int32)], [np.zeros(1)], [np.zeros(1, np.int64)]
    size = np.array([len(order[0])]) if p else np.array([0])
    ids, hashes = np.zeros(1, np.int64), np.array([node], np.uint64)
    n_nodes, depth = 1, 0
    if not used.any():
        return Tree(feature[0], value[0], left[0])
    while len(size):
        # nodes of this level are segments of every order
        first = np.cumsum(size) - size
        o = order[0]
        w_all, s_all = np.add.reduceat(weight[o], first), np.add.reduceat(ws[o], first)
        label = y[o]
        differ = np.minimum.reduceat(label, first) != np.maximum.reduceat(label, first)
        may = differ & (w_all >= 2 * min_leaf) & (max_depth is None or depth < max_depth)
        last = first + size - 1
        apart = np.stack([r[q[first]] != r[q[last]] for r, q in zip(orders.rank, order, strict=True)], axis=1)
        use = drawn(hashes, apart & may[:, None], max_features)
        best, best_f, best_k = np.full(len(size), -np.inf), np.full(len(size), -1), np.zeros(len(size), np.int64)
        for f in range(p):
            use_f = use[:, f]
            mine = np.flatnonzero(use_f)
            if not len(mine):
                continue
            at = order[f] if len(mine) == len(size) else order[f][np.repeat(use_f, size)]
            n = size[mine]
            end = np.cumsum(n)
            begin = end - n
            r = orders.rank[f][at]
            ok = np.empty(len(at), bool)
            np.not_equal(r[1:], r[:-1], out=ok[:-1])
            ok[end - 1] = False  # a node's last row has none to its right
            k = np.flatnonzero(ok)
            s = np.repeat(np.arange(len(mine)), n)
            sk = s[k]
            t = np.cumsum(ws[at])
            tk = t[k] - (t[begin] - ws[at[begin]])[sk]
            if plain:
                wk = (k + 1 - begin[sk]).astype(np.float64)
            else:
                w = np.cumsum(weight[at])
                wk = w[k] - (w[begin] - weight[at[begin]])[sk]
            rk = w_all[mine][sk] - wk
            if min_leaf > 1:
                big = (wk >= min_leaf) & (rk >= min_leaf)
                k, sk, tk, wk, rk = k[big], sk[big], tk[big], wk[big], rk[big]
            if not len(k):
                continue
            over = s_all[mine][sk] - tk
            gain = tk * tk / wk + over * over / rk
            head = np.flatnonzero(np.append(True, sk[1:] != sk[:-1]))
            top = np.maximum.reduceat(gain, head)
            hit = np.flatnonzero(gain == np.repeat(top, np.diff(np.append(head, len(sk)))))
            hit = hit[np.append(True, sk[hit][1:] != sk[hit][:-1])]
            who = mine[sk[hit]]
            better = top > best[who]
            who, hit = who[better], hit[better]
            best[who], best_f[who] = gain[hit], f
            best_k[who] = k[hit] - begin[sk[hit]]  # place of the last row on the left, within the node
        here = np.flatnonzero(best_f >= 0)
        value_now, feature_now, left_now = s_all / w_all, np.full(len(size), LEAF, np.int32), np.zeros(len(size), np.int64)
        go = np.zeros(len(weight), np.int8)  # 0: the row's node is done, 1: left, 2: right
        n_left = np.zeros(len(size), np.int64)
        for f in np.unique(best_f[here]).tolist():
            mine = here[best_f[here] == f]
            at = order[f][np.repeat(best_f == f, size)]
            n = size[mine]
            begin = np.cumsum(n) - n
            s = np.repeat(np.arange(len(mine)), n)
            go[at] = 1 + (np.arange(len(at)) - begin[s] > best_k[mine][s])
            v = x[f]
            a, b = v[at[begin + best_k[mine]]], v[at[begin + best_k[mine] + 1]]
            cut = a + (b - a) * 0.5
            value_now[mine] = np.where((cut >= a) & (cut < b), cut, a)
            n_left[mine] = best_k[mine] + 1
        feature_now[here] = best_f[here]
        left_now[here] = n_nodes + 2 * np.arange(len(here))
        feature[-1][ids], value[-1][ids], left[-1][ids] = feature_now, value_now, left_now
        if not len(here):
            break
        order = [np.concatenate([q[c == 1], q[c == 2]]) for q, c in ((q, go[q]) for q in order)]
        size = np.concatenate([n_left[here], (size - n_left)[here]])
        # the level below: left children at even places, right ones after them
        ids = np.concatenate([2 * np.arange(len(here)), 2 * np.arange(len(here)) + 1])
        hashes = np.concatenate([child_hash(hashes[here], 0), child_hash(hashes[here], 1)])
        feature.append(np.full(2 * len(here), LEAF, np.int32))
        value.append(np.zeros(2 * len(here)))
        left.append(np.zeros(2 * len(here), np.int64))
        n_nodes += 2 * len(here)
        depth += 1
    return Tree(np.concatenate(feature), np.concatenate(value), np.concatenate(left))

