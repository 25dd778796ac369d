"""Regression trees and forests without a depth cap, many at a time.

``grow_trees`` grows any number of trees over one table together: those of a
forest, or of all candidates and folds of a search. A tree's rows are told by
weights: 0 for the fold that is left out, Poisson(1) by hash of key and tree
for a bootstrapped one. So the table is laid out once, never sampled or
shuffled by row for a tree, and trees that several candidates share (same
options, fold and place in the forest) are grown once.

1. The table is packed: some Arrow batches become one row of binary columns,
   written to the shared folder (lineage ends there).
2. While a node of a tree holds more than ``cells`` values (rows x features),
   one pass per level adds up histograms of weight, label and rows for all
   such nodes of all trees. Their borders are quantiles of the whole table, found by
   counting prefixes of the values' bits. The sums bound what any cut
   inside a bin can gain; bins that may hold a better cut than the best border
   are looked into by further passes, with finer bins or value by value, until
   the node's best cut is known. So it is the cut that step 3 would take, and ``cells`` and the layout don't change the model.
3. Rows of smaller nodes meet in a task, which finishes the subtree with exact
   splits (``tree_growth``); its size is bounded by ``cells``. Where the whole
   table is no larger, this is the root, and a task grows several trees from
   one set of sorted orders.

Labels are rounded to whole multiples of a power of two, so that all sums are
exact in doubles: the model doesn't depend on layout or retries. Whole
numbers lose nothing while their sums stay below 2^50; others keep about
50 - log2(rows) bits.

A tree without a cap has about as many leaves as the table has rows, so the
model is a table itself: tops at the driver (their nodes are bounded by table
size / ``cells``), one row per finished subtree in the shared folder.
``ForestModel.transform`` broadcasts it below a checked number of bytes; beyond
it, rows are dealt to the subtrees by their top's leaf and averaged by row.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathe.functions.hashing import key_hash_u32
from lathe.operators.tree_growth import LEAF, Orders, Tree, bag_weights, child_hash, grow, mix32, tree_hash
from lathe.session import stored

#: Values (rows x features) of a node that one task finishes: 32 MB of doubles.
CELLS = 4_000_000
#: A row's arrays in a task (weights, sums, gains, places) take as much as this many features.
ROW_CELLS = 5
#: Bytes of a model that may be broadcast, after they were added up.
MODEL_BYTES = 96 << 20
#: Bytes of dealt rows that one task answers for a smaller subtree.
SHARE_BYTES = 32 << 20
#: Bytes of histograms that one task adds up at a time.
HISTOGRAM_BYTES = 128 << 20
BINS = 128
#: Rows of a packed block.
BLOCK_ROWS = 40_000
#: Rows of a node's stretches whose values are listed, not counted by finer bins.
LISTED = 200_000
_INT, _DOUBLE, _LONG = struct.Struct("=i"), struct.Struct("=d"), struct.Struct("=q")


@dataclass(frozen=True)
class Forest:
    """What to grow: the reference learners' options. One tree with every feature and no bootstrap is ``tree()``."""

    n_estimators: int = 100
    max_features: int | float | str | None = 1.0
    bootstrap: bool = True
    max_depth: int | None = None
    min_leaf: int = 1
    seed: int = 42

    def with_params(self, params: dict) -> Forest:
        names = {"random_state": "seed", "min_samples_leaf": "min_leaf"}
        return replace(self, **{names.get(k, k): v for k, v in params.items()})

    def features_per_split(self, p: int) -> int:
        m = self.max_features
        if m is None:
            return p
        if isinstance(m, str):
            return max(1, int({"sqrt": math.sqrt, "log2": math.log2}[m](p)))
        if isinstance(m, bool) or m <= 0:
            raise ValueError("max_features must be above 0")
        return min(p, m) if isinstance(m, int) else max(1, int(m * p))


def tree(seed: int = 42, max_depth: int | None = None, min_leaf: int = 1) -> Forest:
    return Forest(1, None, False, max_depth, min_leaf, seed)


@dataclass(frozen=True)
class TreeSpec:
    """One tree to grow: its options, the fold left out (None: none) and its place in the forest."""

    max_features: int
    bootstrap: bool
    max_depth: int | None
    min_leaf: int
    seed: int
    number: int
    without: int | None = None

    @property
    def hash(self) -> int:
        return tree_hash(self.seed, self.number)

    def weights(self, key_hash: np.ndarray, fold: np.ndarray) -> np.ndarray:
        w = bag_weights(key_hash, self.hash) if self.bootstrap else np.ones(len(key_hash))
        return w if self.without is None else np.where(fold == self.without, 0.0, w)


def tree_specs(forest: Forest, p: int, without: int | None = None) -> list[TreeSpec]:
    return [TreeSpec(forest.features_per_split(p), bool(forest.bootstrap), forest.max_depth, forest.min_leaf, forest.seed, k, without) for k in range(int(forest.n_estimators))]


def share_of(p: int) -> int:
    """Values that a row counts for in a task's share."""
    return max(p, ROW_CELLS)


# --- the packed table ---------------------------------------------------------------

_BLOCK = "block long, n long, top double, kh binary, fold binary, y binary, x binary"


@dataclass
class Block:
    """Rows of a packed block as arrays."""

    block: int
    kh: np.ndarray
    fold: np.ndarray
    y: np.ndarray
    x: np.ndarray  # by feature, then row
    at: np.ndarray  # places in the block

    def take(self, rows: np.ndarray) -> Block:
        return Block(self.block, self.kh[rows], self.fold[rows], self.y[rows], self.x[:, rows], self.at[rows])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of at least a block's rows, but for the last."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= BLOCK_ROWS:
            yield pa.concat_batches(held)
            held = []
    if sum(b.num_rows for b in held):
        yield pa.concat_batches(held)


def packed(df: DataFrame, features: list[str], label: str | None, key: str | None, fold: str | None) -> DataFrame:
    """Some Arrow batches as one row; a missing feature or label is an error, as the learners have no rule for it."""
    p = len(features)
    zero = F.lit(0).cast("long")
    cols = [
        (key_hash_u32(key, 0) if key else zero).alias("kh"), (F.col(f"`{fold}`").cast("long") if fold else zero).alias("fold"),
        (F.col(f"`{label}`") if label else F.lit(0.0)).cast("double").alias("y"), *[F.col(f"`{c}`").cast("double").alias(f"x{k}") for k, c in enumerate(features)],
    ]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = 0
        for batch in _joined(batches):
            if any(batch.column(k).null_count for k in range(2, p + 3)):
                raise ValueError("features and labels must not be missing: impute them first")
            values = [batch.column(k).to_numpy() for k in range(p + 3)]
            x = np.stack(values[3:]) if p else np.zeros((0, batch.num_rows))
            if not np.isfinite(x).all() or not np.isfinite(values[2]).all():
                raise ValueError("features and labels must be finite numbers")
            row = [(TaskContext.get().partitionId() << 32) + number, batch.num_rows, float(np.abs(values[2]).max()), values[0].astype(np.uint32).tobytes(), values[1].astype(np.int32).tobytes(), values[2].tobytes(), x.tobytes()]
            number += 1
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in row], names=["block", "n", "top", "kh", "fold", "y", "x"])

    return stored(df.select(*cols).mapInArrow(pack, _BLOCK))


def _blocks(batches: Iterator[pa.RecordBatch], p: int, scale: float | None = None) -> Iterator[Block]:
    """Labels scaled and rounded, or as they are."""
    for batch in batches:
        col = {n: batch.column(k) for k, n in enumerate(batch.schema.names)}
        for k in range(batch.num_rows):
            kh, y = np.frombuffer(col["kh"][k].as_buffer(), np.uint32), np.frombuffer(col["y"][k].as_buffer(), np.float64)
            yield Block(
                col["block"][k].as_py(), kh, np.frombuffer(col["fold"][k].as_buffer(), np.int32), y if scale is None else np.rint(y * scale),
                np.frombuffer(col["x"][k].as_buffer(), np.float64).reshape(p, len(kh)), np.arange(len(kh)),
            )


def label_scale(n: int, top: float) -> float:
    """The power of two that labels are multiplied by before they are rounded."""
    if not n or not top:
        return 1.0
    return 2.0 ** min(50 - math.ceil(math.log2(n)) - math.ceil(math.log2(top)), 900)


def _batch(rows: list[tuple], **types: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types.values(), strict=True)], names=list(types))


# --- cut points -----------------------------------------------------------------------


def _keys(x: np.ndarray) -> np.ndarray:
    """64-bit numbers in the order of the doubles; -0.0 as 0.0."""
    bits = (x + 0.0).view(np.uint64)
    return np.where(bits >> np.uint64(63), ~bits, bits | np.uint64(1 << 63))


def _value(key: int) -> float:
    bits = key ^ (1 << 63) if key >> 63 else ~key & (1 << 64) - 1
    return float(np.array([bits], np.uint64).view(np.float64)[0])


def _prefixes(p: int, shift: int, inside: list[np.ndarray] | None, above: int):
    """Rows per feature and prefix; ``inside``: only below these prefixes of the last pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[dict[int, int]] = [{} for _ in range(p)]
        for b in _blocks(batches, p):
            for f in range(p):
                keys = _keys(b.x[f])
                if inside is not None:
                    keys = keys[np.isin(keys >> np.uint64(above), inside[f])]
                for k, c in zip(*[a.tolist() for a in np.unique(keys >> np.uint64(shift), return_counts=True)], strict=True):
                    found[f][k] = found[f].get(k, 0) + c
        rows = [(f, str(k), c) for f, own in enumerate(found) for k, c in own.items()]
        if rows:
            yield _batch(rows, f=pa.int32(), prefix=pa.string(), n=pa.int64())

    return run


def cut_points(table: DataFrame, n: int, p: int) -> list[np.ndarray]:
    """At most BINS - 1 values per feature that split the rows about evenly: prefixes that hold more than a bin's share are looked into."""
    done: list[list[tuple[int, int]]] = [[] for _ in range(p)]  # (greatest key of the prefix, rows)
    inside, above = None, 64
    for shift in (48, 36, 24, 12, 0):
        counted = table.mapInArrow(_prefixes(p, shift, inside, above), "f int, prefix string, n long").groupBy("f", "prefix").agg(F.sum("n").alias("n")).collect()
        heavy: list[list[int]] = [[] for _ in range(p)]
        for r in counted:
            k = int(r["prefix"])
            if shift and r["n"] * BINS > n:
                heavy[r["f"]].append(k)
            else:
                done[r["f"]].append(((k + 1 << shift) - 1, r["n"]))
        if not any(heavy):
            break
        inside, above = [np.array(h, np.uint64) for h in heavy], shift
    out = []
    for own in done:
        own.sort()
        below = np.cumsum([c for _, c in own])
        at = np.searchsorted(below, np.arange(1, BINS) * n / BINS, "left")
        cuts = [_value(own[k][0]) for k in np.unique(at).tolist() if k < len(own)]
        out.append(np.array(cuts if len(own) > BINS else [_value(k) for k, _ in own][: BINS - 1]))
    return out


# --- tops: levels of nodes too large for a task ----------------------------------------


@dataclass
class Top:
    """The upper part of a tree. ``unit``: the subtree that goes on at a node, or -1."""

    feature: list[int] = field(default_factory=lambda: [LEAF])
    value: list[float] = field(default_factory=lambda: [0.0])
    left: list[int] = field(default_factory=lambda: [0])
    unit: list[int] = field(default_factory=lambda: [-1])
    hash: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=lambda: [0])

    def as_tree(self) -> Tree:
        return Tree(np.array(self.feature, np.int32), np.array(self.value), np.array(self.left, np.int64))

    def split(self, node: int, feature: int, cut: float) -> tuple[int, int]:
        self.feature[node], self.value[node], self.left[node] = feature, cut, len(self.feature)
        for side in (0, 1):
            self.feature.append(LEAF)
            self.value.append(0.0)
            self.left.append(0)
            self.unit.append(-1)
            self.hash.append(int(child_hash(self.hash[node], side)))
            self.depth.append(self.depth[node] + 1)
        return self.left[node], self.left[node] + 1


@dataclass
class Open:
    """A node whose best cut is being narrowed down: the best border of bins so far, and the stretches that may hold a better one."""

    low: float  # least and greatest label, weight and label sum of the node
    high: float
    weight: float
    total: float
    best: tuple[float, int, float] = (-np.inf, LEAF, 0.0)  # gain, feature, border
    ends: tuple[float, float] | None = None  # the values on both sides of the cut, once they are known
    most: tuple[int, int] = (0, 0)  # at most so many rows on each side
    stretches: np.ndarray = field(default_factory=lambda: np.zeros((0, len(_STRETCH))))
    rounds: int = 0
    listed: bool = True  # whether the values themselves are looked at, as they are few

    def leave(self, stretches: bytes) -> None:
        self.stretches = np.frombuffer(bytes(stretches)).reshape(-1, len(_STRETCH))
        self.listed = bool(self.stretches[:, _ROWS].sum() <= LISTED)

    def stretches_of(self) -> dict[int, np.ndarray]:
        own = self.stretches
        return {int(f): own[own[:, 0] == f] for f in np.unique(own[:, 0])}


#: A stretch: values of a feature above ``lo`` up to ``hi``, weight and label sum below and inside it, rows inside, most rows on both sides of a cut in it.
_STRETCH = ("f", "lo", "hi", "w0", "s0", "w", "s", "rows", "most_left", "most_right")
_ROWS = 7


def _boxes(top: Top) -> list[dict[int, tuple[float, float]]]:
    """For each node, by feature, what its rows' values lie above and up to. A chain of cuts is a few comparisons then, however long."""
    boxes: list[dict[int, tuple[float, float]]] = [{} for _ in top.feature]
    for k, (f, cut, left) in enumerate(zip(top.feature, top.value, top.left, strict=True)):
        if f != LEAF:  # children come after their parents
            lo, hi = boxes[k].get(f, (-np.inf, np.inf))
            boxes[left], boxes[left + 1] = boxes[k] | {f: (lo, min(hi, cut))}, boxes[k] | {f: (max(lo, cut), hi)}
    return boxes


def _inside(box: dict[int, tuple[float, float]], b: Block) -> np.ndarray:
    """Rows of a block in a node."""
    found = np.ones(len(b.kh), bool)
    for f, (lo, hi) in box.items():
        if lo > -np.inf:
            found &= b.x[f] > lo
        if hi < np.inf:
            found &= b.x[f] <= hi
    return np.flatnonzero(found)


def _histograms(specs, boxes, wanted: dict[tuple[int, int], list[int]], cuts, size: int):
    """Of a task's blocks, by open node: weight, label sum and rows per wanted feature and bin; least and greatest label and values."""
    sums = {k: np.zeros((3, len(want), size)) for k, want in wanted.items()}
    ends = {k: np.array([[np.inf], [-np.inf]]).repeat(len(want) + 1, 1) for k, want in wanted.items()}

    def add(b: Block) -> None:
        bins: dict[int, np.ndarray] = {}
        for (t, node), want in wanted.items():
            rows = _inside(boxes[t][node], b)
            if not len(rows):
                continue
            w = specs[t].weights(b.kh[rows], b.fold[rows])
            ws, used = w * b.y[rows], rows[w > 0]
            h, end = sums[t, node], ends[t, node]
            for c, f in enumerate(want):
                if f not in bins:
                    bins[f] = np.searchsorted(cuts[f], b.x[f], "left")
                k = bins[f][rows]
                for side, x in enumerate((w, ws, None)):
                    h[side, c] += np.bincount(k, x, size)
            for c, v in enumerate([b.x[f][used] for f in want] + [b.y[used]]):
                end[:, c] = min(end[0, c], v.min(initial=np.inf)), max(end[1, c], v.max(initial=-np.inf))

    return add, lambda: [(*k, None, *ends[k][:, -1].tolist(), h.tobytes(), ends[k][:, :-1].tobytes()) for k, h in sums.items() if h.any()]


def _bound(w0, s0, w, s, node) -> np.ndarray:
    """No cut inside the stretch gains more.

    The gain is convex in the weight and label sum on the left. Those that a cut
    inside may have lie in a parallelogram, as labels lie between the least
    and the greatest, so the gain is greatest at a corner: the lowest labels first, or the
    highest. The other two corners are the stretch's ends.
    """
    low, high, weight, total = node
    few = (w * high - s) / (high - low)  # rows with the lowest label, if the others have the highest
    best = np.full(np.shape(w), -np.inf)
    with np.errstate(divide="ignore", invalid="ignore"):
        for a, b in ((0.0, 0.0), (w, s), (few, few * low), (w - few, (w - few) * high)):
            wl, sl = w0 + a, s0 + b
            wr, sr = weight - wl, total - sl
            best = np.maximum(best, np.where(wl > 0, sl * sl / wl, 0.0) + np.where(wr > 0, sr * sr / wr, 0.0))
    return best * (1 + 1e-9)


def _better(gain: float, f: int, cut: float, than: tuple) -> bool:
    """Of equal gains the first feature's, then the lowest value's."""
    return gain > than[0] or gain == than[0] > -np.inf and (f, cut) < tuple(than[1:3])


_JUDGED = "tree int, node int, state int, rows long, low double, high double, weight double, total double, gain double, feature int, cut double, a double, b double, left long, right long, stretches binary"
_JUDGED_TYPES = [*[pa.int32()] * 3, pa.int64(), *[pa.float64()] * 5, pa.int32(), *[pa.float64()] * 3, *[pa.int64()] * 2, pa.binary()]


def _judge(specs, wanted, opened, cuts, extents, p: int):
    """What a pass says of a node."""
    schema = pa.schema(list(zip([x.split()[0] for x in _JUDGED.split(", ")], _JUDGED_TYPES, strict=True)))

    def run(parts: pa.Table) -> pa.Table:
        k = parts["tree"][0].as_py(), parts["node"][0].as_py()
        row = _best_border(specs[k[0]], wanted[k], cuts, extents, p, parts) if k in wanted else _narrow(specs[k[0]], opened[k], parts)
        return pa.table([pa.array([v], c) for v, c in zip((*k, *row), _JUDGED_TYPES, strict=True)], schema=schema)

    return run


def _best_border(spec: TreeSpec, want: list[int], cuts, extents, p: int, parts: pa.Table) -> tuple:
    """The best border of a node from its histograms, and the bins inside which a cut may gain as much. State 0: a leaf, 1: open, 2: more features must be counted."""
    h = np.zeros((3, len(want), extents.shape[2]))
    for x in parts["data"]:
        h += np.frombuffer(x.as_buffer(), np.float64).reshape(h.shape)
    ends = np.stack([np.frombuffer(x.as_buffer(), np.float64).reshape(2, -1) for x in parts["ends"]])
    differs = ends[:, 0].min(axis=0) < ends[:, 1].max(axis=0)
    low, high = np.min(parts["low"].to_numpy()), np.max(parts["high"].to_numpy())
    weight, total, rows = h[0, 0].sum(), h[1, 0].sum(), int(h[2, 0].sum())
    state, best, left, found = 0, (-np.inf, LEAF, 0.0), 0, np.zeros((0, len(_STRETCH)))
    if low < high and weight >= 2 * spec.min_leaf:
        used = [k for k in range(len(want)) if differs[k]][: spec.max_features]
        state = 2 if len(used) < spec.max_features and len(want) < p else 1 if used else 0
    if state == 1:
        stretches = []
        for k in used:
            f, (w, s, n) = want[k], np.cumsum(h[:, k], axis=1)
            ok = np.flatnonzero((h[0, k][:-1] > 0) & (w[:-1] >= spec.min_leaf) & (weight - w[:-1] >= spec.min_leaf))
            if len(ok):
                gain = s[ok] * s[ok] / w[ok] + (total - s[ok]) * (total - s[ok]) / (weight - w[ok])
                at = int(ok[gain.argmax()])
                if _better(gain.max(), f, float(cuts[f][at]), best):
                    best, left = (float(gain.max()), f, float(cuts[f][at])), int(n[at])
            wide = np.flatnonzero((h[2, k] > 1) & (h[0, k] > 0) & (extents[0, f] < extents[1, f]))
            own = [np.full(len(wide), f), np.nextafter(extents[0, f, wide], -np.inf), extents[1, f, wide], (w - h[0, k])[wide], (s - h[1, k])[wide], *h[:, k, wide], n[wide], (rows - n + h[2, k])[wide]]
            stretches.append(np.stack(own, axis=1))
        found = np.concatenate(stretches)
        found = found[_bound(*found[:, 3:7].T, (low, high, weight, total)) >= best[0]]
    return state, rows, low, high, weight, total, *best, None, None, left, rows - left, found.tobytes()


def _edges(lo: float, hi: float, rounds: int) -> np.ndarray:
    """Values that part the stretch, its ends among them: evenly spaced at first, then by the doubles between the ends, so that some passes end it whatever the values are."""
    step = hi - lo
    if not rounds and np.isfinite(step):
        inner = lo + step * (np.arange(1, BINS) / BINS)
    else:
        a, b = _keys(np.array([lo, hi]))
        step, k = b - a, np.arange(1, BINS, dtype=np.uint64)
        keys = a + step // np.uint64(BINS) * k + step % np.uint64(BINS) * k // np.uint64(BINS)
        inner = np.where(keys >> np.uint64(63), keys ^ np.uint64(1 << 63), ~keys).view(np.float64)
    return np.concatenate([[lo], np.unique(inner[(inner > lo) & (inner < hi)]), [hi]])


def _look(specs, boxes, todo: dict[tuple[int, int], Open]):
    """Of a task's blocks, by node: values or counts by edges inside its stretches, and the values on both sides of its best border."""
    own = {k: o.stretches_of() for k, o in todo.items()}
    edges = {(k, f): np.concatenate([_edges(r[1], r[2], o.rounds) for r in s]) for k, o in todo.items() if not o.listed for f, s in own[k].items()}
    # weight, label sum, rows, least and greatest value
    sums = {k: np.array([[0.0], [0.0], [0.0], [np.inf], [-np.inf]]).repeat(len(e) + 1, 1) for k, e in edges.items()}
    lists: dict[tuple, list[np.ndarray]] = {}
    ends = {k: [-np.inf, np.inf] for k in todo}

    def add(b: Block) -> None:
        for k, o in todo.items():
            t, node = k
            rows = _inside(boxes[t][node], b)
            w = specs[t].weights(b.kh[rows], b.fold[rows])
            if not w.all():
                rows, w = rows[w > 0], w[w > 0]
            if not len(rows):
                continue
            ws = w * b.y[rows]
            if o.best[1] != LEAF and o.ends is None:
                v = b.x[o.best[1]][rows]
                left = v <= o.best[2]
                ends[k] = [max(ends[k][0], v[left].max(initial=-np.inf)), min(ends[k][1], v[~left].min(initial=np.inf))]
            for f, s in own[k].items():
                v = b.x[f][rows]
                if (k, f) in edges:
                    place = np.searchsorted(edges[k, f], v, "left")
                    for c, x in enumerate((w, ws, None)):
                        sums[k, f][c] += np.bincount(place, x, sums[k, f].shape[1])
                    np.minimum.at(sums[k, f][3], place, v)
                    np.maximum.at(sums[k, f][4], place, v)
                    continue
                place = np.searchsorted(s[:, 2], v, "left")
                inside = np.flatnonzero(v > np.append(s[:, 1], np.inf)[place])
                if len(inside):
                    lists.setdefault((k, f), []).append(_by_value(v[inside], w[inside], ws[inside]))

    def rows() -> list[tuple]:
        out = [(*k, f, None, None, h.tobytes(), None) for (k, f), h in sums.items() if h[2].any()]
        out += [(*k, f, None, None, _by_value(*np.concatenate(v, axis=1)).tobytes(), None) for (k, f), v in lists.items()]
        return out + [(*k, -1, None, None, None, np.array(v).tobytes()) for k, v in ends.items()]

    return add, rows


_PASS = dict(tree=pa.int32(), node=pa.int32(), f=pa.int32(), low=pa.float64(), high=pa.float64(), data=pa.binary(), ends=pa.binary())


def _pass(specs, tops, wanted, opened, cuts, size: int, p: int, scale: float):
    """One scan for the nodes to be counted and those to be looked into."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        boxes = {t: _boxes(tops[t]) for t in {t for t, _ in [*wanted, *opened]}}
        jobs = [_histograms(specs, boxes, wanted, cuts, size), _look(specs, boxes, opened)]
        for b in _blocks(batches, p, scale):
            for add, _ in jobs:
                add(b)
        out = [r for _, rows in jobs for r in rows()]
        if out:
            yield _batch(out, **_PASS)

    return run


def _by_value(v: np.ndarray, w: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Distinct values in order with their weight and label sum."""
    order = np.argsort(v, kind="stable")
    v = v[order]
    head = np.flatnonzero(np.append(True, v[1:] != v[:-1]))
    return np.stack([v[head], np.add.reduceat(w[order], head), np.add.reduceat(s[order], head)])


def _narrow(spec: TreeSpec, o: Open, parts: pa.Table) -> tuple:
    """The best cut after a look into a node's stretches, and what is left of them."""
    least = spec.min_leaf
    a, b = o.ends or (-np.inf, np.inf)
    data: dict[int, list[np.ndarray]] = {}
    for f, x, e in zip(parts["f"].to_pylist(), parts["data"], parts["ends"], strict=True):
        if f < 0:
            got = np.frombuffer(e.as_buffer(), np.float64)
            a, b = (max(a, got[0]), min(b, got[1])) if o.ends is None else (a, b)
        else:
            data.setdefault(f, []).append(np.frombuffer(x.as_buffer(), np.float64).reshape(3 if o.listed else 5, -1))
    best, ends, most, rest = o.best, (a, b), o.most, []
    for f, own in o.stretches_of().items():
        if f not in data:
            continue
        if o.listed:
            every = _by_value(*np.concatenate(data[f], axis=1))
        else:
            every, at = np.stack(data[f]), 0
            every = np.concatenate([every[:, :3].sum(axis=0), every[:, 3:4].min(axis=0), every[:, 4:].max(axis=0)])
        for r in own:
            if o.listed:
                lo, hi = np.searchsorted(every[0], r[1:3], "right")
                v, w, s = every[:, lo:hi]
                cut, after = v[:-1], v[1:]
            else:
                e = _edges(r[1], r[2], o.rounds)
                w, s, n, lo, hi = every[:, at + 1 : at + len(e)]
                at, cut, after = at + len(e), e[1:-1], None
            wl, sl = r[3] + np.cumsum(w), r[4] + np.cumsum(s)
            ok = np.flatnonzero((w[:-1] > 0) & (wl[:-1] >= least) & (o.weight - wl[:-1] >= least))
            if len(ok):
                x, y = wl[ok], sl[ok]
                gain = y * y / x + (o.total - y) * (o.total - y) / (o.weight - x)
                k = int(ok[gain.argmax()])
                if _better(gain.max(), f, float(cut[k]), best):
                    best, most = (float(gain.max()), f, float(cut[k])), (int(r[8]), int(r[9]))
                    ends = None if after is None else (float(cut[k]), float(after[k]))
            if not o.listed:
                wide = np.flatnonzero(lo < hi)
                of = [np.full(len(wide), f), np.nextafter(lo[wide], -np.inf), hi[wide], (wl - w)[wide], (sl - s)[wide], w[wide], s[wide], n[wide], np.full(len(wide), r[8]), np.full(len(wide), r[9])]
                rest.append(np.stack(of, axis=1))
    left = np.concatenate(rest) if rest else np.zeros((0, len(_STRETCH)))
    left = left[_bound(*left[:, 3:7].T, (o.low, o.high, o.weight, o.total)) >= best[0]]
    return None, None, None, None, None, None, *best, *(ends or (None, None)), *most, left.tobytes()


def _lots(spec: TreeSpec, hash: int, p: int) -> list[int]:
    """Features in the order in which a node draws them; with all drawn, as they stand."""
    if spec.max_features >= p:
        return list(range(p))
    return mix32(np.uint64(hash) ^ mix32(np.arange(1, p + 1, dtype=np.uint64))).argsort().tolist()


def _grow_tops(table: DataFrame, specs: list[TreeSpec], n: int, p: int, scale: float, quantiles: list[np.ndarray], cells: int) -> list[Top]:
    """Splits, level by level, every node of more than ``cells`` values by its best cut; only borders, stretches and cuts reach the driver.

    Histograms give the gain at every border of bins and, by their sums, a
    bound of the gain of any cut inside a bin. Bins that may hold a better cut
    than the best border are looked into, by finer bins or, where they hold few rows,
    by the values themselves, until none is left: the cut is the one
    that all values would give, as in the smaller nodes.
    """
    tops = [Top(hash=[s.hash]) for s in specs]
    if n * share_of(p) <= cells:
        return tops
    extents = _bin_extents(table, quantiles, p)
    at_once = max(1, HISTOGRAM_BYTES // (3 * 8 * BINS * max(p, 1)))

    def drawing(t: int, node: int) -> list[int]:
        # a node that has drawn features of equal values draws on: some more are counted than it needs
        return _lots(specs[t], tops[t].hash[node], p)[: specs[t].max_features + 3]

    # nodes go on at their own pace, so that a pass serves nodes of all trees and levels
    wanted, opened = {(t, 0): drawing(t, 0) for t in range(len(specs))}, {}
    while wanted or opened:
        counted, looked, room = dict(list(wanted.items())[:at_once]), {}, HISTOGRAM_BYTES
        for k, o in opened.items():
            room -= 24 * BINS * (1 + len(o.stretches))
            if looked and room < 0:
                break
            looked[k] = o
        parts = table.mapInArrow(_pass(specs, tops, counted, looked, quantiles, BINS, p, scale), "tree int, node int, f int, low double, high double, data binary, ends binary")
        for r in parts.groupBy("tree", "node").applyInArrow(_judge(specs, counted, looked, quantiles, extents, p), _JUDGED).collect():
            t, node, top = r["tree"], r["node"], tops[r["tree"]]
            best, ends = (r["gain"], r["feature"], r["cut"]), None if r["a"] is None else (r["a"], r["b"])
            if r["state"] == 2:
                wanted[t, node] = _lots(specs[t], top.hash[node], p)
                continue
            if r["state"] is not None:
                del wanted[t, node]
                top.value[node] = r["total"] / r["weight"] if r["weight"] else 0.0
                if not r["state"] or specs[t].max_depth is not None and top.depth[node] >= specs[t].max_depth:
                    continue
                o = Open(r["low"], r["high"], r["weight"], r["total"], rounds=-1)
            else:
                o = opened.pop((t, node))
            o.best, o.ends, o.most, o.rounds = best, ends, (r["left"], r["right"]), o.rounds + 1
            o.leave(r["stretches"])
            if len(o.stretches) or best[1] != LEAF and ends is None:
                opened[t, node] = o
            elif best[1] != LEAF:
                a, b = ends
                cut = a + (b - a) * 0.5
                for child, rows in zip(top.split(node, best[1], cut if a <= cut < b else a), o.most, strict=True):
                    if rows * share_of(p) > cells:
                        wanted[t, child] = drawing(t, child)
                    else:
                        top.unit[child] = 0  # numbered when all are known
    return tops


def _bin_extents(table: DataFrame, cuts: list[np.ndarray], p: int) -> np.ndarray:
    """Least and greatest value in each bin of each feature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.array([[[np.inf]], [[-np.inf]]]).repeat(p, 1).repeat(BINS, 2)
        for b in _blocks(batches, p):
            for f in range(p):
                v = np.unique(b.x[f])
                place = np.searchsorted(cuts[f], v, "left")
                head = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
                own, last = place[head], np.append(head[1:], len(v)) - 1
                found[0, f, own], found[1, f, own] = np.minimum(found[0, f, own], v[head]), np.maximum(found[1, f, own], v[last])
        yield _batch([(f, found[:, f].tobytes()) for f in range(p)], f=pa.int32(), ends=pa.binary())

    def both(parts: pa.Table) -> pa.Table:
        own = np.stack([np.frombuffer(x.as_buffer(), np.float64).reshape(2, BINS) for x in parts["ends"]])
        return pa.table([[parts["f"][0].as_py()], [np.stack([own[:, 0].min(axis=0), own[:, 1].max(axis=0)]).tobytes()]], schema=pa.schema([("f", pa.int32()), ("ends", pa.binary())]))

    out = np.zeros((2, p, BINS))
    for r in table.mapInArrow(run, "f int, ends binary").groupBy("f").applyInArrow(both, "f int, ends binary").collect():
        out[:, r["f"]] = np.frombuffer(bytes(r["ends"])).reshape(2, BINS)
    return out


# --- subtrees finished inside a task ------------------------------------------------------

_PART = "unit long, salt long, block long, n long, top double, kh binary, fold binary, y binary, x binary, places binary"


@dataclass(frozen=True)
class Unit:
    """What one task grows: trees by number, from this node of their tops (with one tree), or a leaf's value."""

    trees: tuple[int, ...]
    node: int = 0
    value: float | None = None


def _deal(units: list[Unit], tops, p: int, specs: list[TreeSpec] | None):
    """Rows of every block to the units of their trees' tops. With ``specs`` only those that a tree grows on: not of a closed leaf, nor of weight 0."""
    by_tree: dict[int, list[tuple[int, Unit]]] = {}
    for k, u in enumerate(units):
        if specs is None or u.value is None:
            by_tree.setdefault(u.trees[0], []).append((k, u))
    names = [x.split()[0] for x in _PART.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = {t: tops[t].as_tree() for t in by_tree}
        for b in _blocks(batches, p):
            for t, own in by_tree.items():
                at = trees[t].nodes_of(b.x)
                if specs is not None:
                    at[specs[t].weights(b.kh, b.fold) == 0] = -1
                order = np.argsort(at, kind="stable")
                first, last = (np.searchsorted(at[order], [u.node for _, u in own], side) for side in ("left", "right"))
                for (k, u), lo, hi in zip(own, first.tolist(), last.tolist(), strict=True):
                    rows = order[lo:hi]
                    if len(rows):
                        c = b.take(rows)
                        # rows of a closed leaf need no meeting: one group for each block
                        salt = b.block if u.value is not None else -1
                        row = [k, salt, b.block, len(rows), 0.0, c.kh.tobytes(), c.fold.tobytes(), c.y.tobytes(), np.ascontiguousarray(c.x).tobytes(), c.at.astype(np.int32).tobytes()]
                        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in row], names=names)

    return run


def _units(specs: list[TreeSpec], tops: list[Top], parallelism: int, whole: bool) -> list[Unit]:
    if whole:
        # whole tables: several trees from one set of orders, but units enough for every core
        size = max(1, len(specs) // (3 * max(parallelism, 1)))
        return [Unit(tuple(range(k, min(k + size, len(specs))))) for k in range(0, len(specs), size)]
    out = []
    for t, top in enumerate(tops):
        for node, f in enumerate(top.feature):
            if f == LEAF:
                if top.unit[node] >= 0:
                    top.unit[node] = len(out)
                    out.append(Unit((t,), node))
                else:
                    top.unit[node] = len(out)
                    out.append(Unit((t,), node, top.value[node]))
    return out


def _rows_of_units(table: DataFrame, units: list[Unit], tops, p: int, whole: bool, specs: list[TreeSpec] | None) -> DataFrame:
    if whole:
        parts = table.select(F.explode(F.expr(f"sequence(0L, {len(units) - 1}L)")).alias("unit"), F.lit(-1).cast("long").alias("salt"), *table.columns, F.lit(None).cast("binary").alias("places"))
    else:
        parts = table.mapInArrow(_deal(units, tops, p, specs), _PART)
    # more partitions than units, so that few tasks hold two of them
    return parts.repartition(min(4 * len(units), 100_000), "unit", "salt")


def _gathered(parts: pa.Table, p: int, scale: float) -> tuple[Block, list[tuple[int, int, int]]]:
    """One block of all the unit's rows, in an order that no layout changes, and where each block's rows stand."""
    rows = []
    for k in range(parts.num_rows):
        kh = np.frombuffer(parts["kh"][k].as_buffer(), np.uint32)
        places = parts["places"][k]
        rows.append(Block(
            parts["block"][k].as_py(), kh, np.frombuffer(parts["fold"][k].as_buffer(), np.int32), np.frombuffer(parts["y"][k].as_buffer(), np.float64),
            np.frombuffer(parts["x"][k].as_buffer(), np.float64).reshape(p, len(kh)), np.frombuffer(places.as_buffer(), np.int32) if places.is_valid else np.arange(len(kh), dtype=np.int32),
        ))
    rows.sort(key=lambda b: b.block)
    ends = np.cumsum([0] + [len(b.kh) for b in rows])
    spans = [(b.block, int(lo), int(hi)) for b, lo, hi in zip(rows, ends[:-1], ends[1:], strict=True)]
    whole = Block(-1, *[np.concatenate([getattr(b, f) for b in rows]) for f in ("kh", "fold", "y")], np.concatenate([b.x for b in rows], axis=1), np.concatenate([b.at for b in rows]))
    whole.y = np.rint(whole.y * scale)
    return whole, spans


def _finished(unit: Unit, specs, tops, rows: Block) -> Iterator[tuple[int, Tree]]:
    if unit.value is not None:
        yield unit.trees[0], Tree(np.array([LEAF], np.int32), np.array([unit.value]), np.zeros(1, np.int64))
        return
    orders = Orders(rows.x)
    for t in unit.trees:
        spec, top = specs[t], tops[t]
        depth = None if spec.max_depth is None else spec.max_depth - top.depth[unit.node]
        yield t, grow(orders, rows.y, spec.weights(rows.kh, rows.fold), spec.max_features, top.hash[unit.node], depth, spec.min_leaf)


_SUBTREE = "tree int, unit long, nodes long, feature binary, value binary, left binary"


def _to_subtrees(units, specs, tops, p: int, scale: float):
    names = [x.split()[0] for x in _SUBTREE.split(", ")]
    schema = pa.schema(list(zip(names, [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()], strict=True)))

    def run(parts: pa.Table) -> pa.Table:
        k = parts["unit"][0].as_py()
        rows, _ = _gathered(parts, p, scale)
        out = []
        for t, got in _finished(units[k], specs, tops, rows):
            value = np.where(got.feature == LEAF, got.value / scale, got.value)
            out.append((t, k if tops[t].unit[units[k].node] >= 0 else -1, len(value), got.feature.tobytes(), value.tobytes(), got.left.tobytes()))
        return pa.table([list(c) for c in zip(*out, strict=True)], schema=schema)

    return run


_GUESS = "tree int, block long, places binary, guess binary, y binary, fold binary"


def _to_guesses(units, specs, tops, p: int, scale: float):
    names = [x.split()[0] for x in _GUESS.split(", ")]
    schema = pa.schema(list(zip(names, [pa.int32(), pa.int64(), *[pa.binary()] * 4], strict=True)))

    def run(parts: pa.Table) -> pa.Table:
        rows, spans = _gathered(parts, p, scale)
        out = []
        for t, got in _finished(units[parts["unit"][0].as_py()], specs, tops, rows):
            guess = got.predict(rows.x) / scale
            first = specs[t].number == 0  # labels go along once for each forest
            for block, lo, hi in spans:
                # null places: the whole block in its order
                at = rows.at[lo:hi]
                places = None if len(at) == 1 + at[-1] else at.astype(np.int32).tobytes()
                out.append((t, block, places, guess[lo:hi].tobytes(), (rows.y[lo:hi] / scale).tobytes() if first else None, rows.fold[lo:hi].tobytes() if first else None))
        return pa.table([list(c) for c in zip(*out, strict=True)], schema=schema)

    return run


# --- models ----------------------------------------------------------------------------------


@dataclass
class ForestModel:
    """A grown forest: tops at the driver, subtrees as a table (tree, unit, nodes, feature, value, left)."""

    features: tuple[str, ...]
    tops: list[Top]
    subtrees: DataFrame
    params: dict

    def transform(self, df: DataFrame, pred: str = "prediction", model_bytes: int = MODEL_BYTES) -> DataFrame:
        size = self.subtrees.agg(F.sum(F.col("nodes") * 20 + 200)).first()[0] or 0
        return self._by_broadcast(df, pred) if size <= model_bytes else self._by_subtree(df, pred)

    def _by_broadcast(self, df: DataFrame, pred: str) -> DataFrame:
        trees: dict[int, dict[int, tuple]] = {}
        for r in self.subtrees.collect():  # checked: at most ``model_bytes``
            trees.setdefault(r["tree"], {})[r["unit"]] = (bytes(r["feature"]), bytes(r["value"]), bytes(r["left"]))
        model = df.sparkSession.sparkContext.broadcast((self.tops, trees))

        @F.arrow_udf("double")
        def predict(rows: pa.Array) -> pa.Array:
            tops, trees = model.value
            x = np.stack([c.to_numpy(zero_copy_only=False) for c in rows.flatten()])
            total = np.zeros(x.shape[1])
            for t, own in sorted(trees.items()):
                total += _guess(tops[t], own, x)
            return pa.array(total / len(trees))

        return df.withColumn(pred, predict(F.struct(*[F.col(f"`{c}`").cast("double").alias(f"x{k}") for k, c in enumerate(self.features)])))

    def copies(self, table: DataFrame, share: int = SHARE_BYTES) -> dict[tuple[int, int], int]:
        """Tasks that each subtree goes to; ``table``: row numbers and features."""
        # a row per subtree: as many as the tops, which are at the driver, have ends
        nodes = {(r["tree"], r["unit"]): r["nodes"] for r in self.subtrees.select("tree", "unit", "nodes").collect()}
        p = len(self.features)
        reached = table.mapInArrow(_reached(self.tops, p), "tree int, unit long, n long").groupBy("tree", "unit").agg(F.sum("n").alias("n")).collect()
        return {(r["tree"], r["unit"]): max(1, -(-r["n"] * (8 * p + 12) // max(share, 20 * nodes[r["tree"], r["unit"]]))) for r in reached}

    def _by_subtree(self, df: DataFrame, pred: str, share: int = SHARE_BYTES) -> DataFrame:
        """Rows dealt to the subtrees they reach, the trees' answers averaged by block of rows.

        A subtree goes once to every task that holds rows of it: so many that a
        task's rows take ``share`` bytes or as many as the subtree. All copies
        together are then no larger than the model and the dealt rows.
        """
        p, tops = len(self.features), self.tops
        keyed = stored(df.withColumn("_row", F.monotonically_increasing_id()))
        table = keyed.select("_row", *[F.col(f"`{c}`").cast("double").alias(f"_x{k}") for k, c in enumerate(self.features)])
        many = {k: c for k, c in self.copies(table, share).items() if c > 1}
        own = self.subtrees.withColumn("salt", F.lit(0).cast("long"))
        if many:
            more = df.sparkSession.createDataFrame([(t, u, s) for (t, u), c in many.items() for s in range(1, c)], "tree int, unit long, salt long")
            own = own.unionByName(self.subtrees.join(F.broadcast(more), ["tree", "unit"]).select(*own.columns))

        def answer(rows: pa.Table, model: pa.Table) -> pa.Table:
            out = []
            if rows.num_rows:
                sub = _tree_of(*[model[c][0].as_py() for c in ("feature", "value", "left")])
                for k in range(rows.num_rows):
                    x = np.frombuffer(rows["x"][k].as_buffer(), np.float64).reshape(p, -1)
                    out.append((rows["block"][k].as_py(), rows["tree"][k].as_py(), rows["places"][k].as_py(), rows["ids"][k].as_py(), sub.predict(x).tobytes()))
            names = ("block", "tree", "places", "ids", "v")
            types = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
            return pa.table({n: pa.array([r[k] for r in out], t) for k, (n, t) in enumerate(zip(names, types, strict=True))})

        def average(parts: pa.Table) -> pa.Table:
            at_of = [np.frombuffer(v.as_buffer(), np.int32) for v in parts["places"]]
            n = 1 + max(int(a.max()) for a in at_of)
            ids, total = np.zeros(n, np.int64), np.zeros(n)
            for tree, k in sorted((t, k) for k, t in enumerate(parts["tree"].to_pylist())):
                total[at_of[k]] += np.frombuffer(parts["v"][k].as_buffer(), np.float64)
                if tree == 0:
                    ids[at_of[k]] = np.frombuffer(parts["ids"][k].as_buffer(), np.int64)
            return pa.table({"_r": ids, pred: total / len(tops)})

        keys = ["tree", "unit", "salt"]
        dealt = table.mapInArrow(_dealt(tops, p, many), "tree int, unit long, salt long, block long, places binary, ids binary, x binary")
        answers = dealt.groupBy(*keys).cogroup(own.groupBy(*keys)).applyInArrow(answer, "block long, tree int, places binary, ids binary, v binary")
        mean = answers.groupBy("block").applyInArrow(average, f"_r long, `{pred}` double")
        return keyed.join(mean, F.col("_row") == F.col("_r"), "left").select(*df.columns, pred)


def _unit_of(tops: list[Top]):
    """Function of features: the subtree that every row reaches, by tree."""
    trees, units = [t.as_tree() for t in tops], [np.array(t.unit, np.int64) for t in tops]
    return lambda x: ((t, unit[top.nodes_of(x)]) for t, (top, unit) in enumerate(zip(trees, units, strict=True)))


def _values(batch: pa.RecordBatch, p: int) -> np.ndarray:
    return np.stack([batch.column(k + 1).to_numpy(zero_copy_only=False) for k in range(p)])


def _reached(tops: list[Top], p: int):
    """Rows per subtree, by task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit_of, found = _unit_of(tops), {}
        for batch in batches:
            for t, units in unit_of(_values(batch, p)) if batch.num_rows else ():
                for u, n in zip(*[a.tolist() for a in np.unique(units, return_counts=True)], strict=True):
                    found[t, u] = found.get((t, u), 0) + n
        if found:
            yield _batch([(*k, n) for k, n in found.items()], tree=pa.int32(), unit=pa.int64(), n=pa.int64())

    return run


def _dealt(tops: list[Top], p: int, copies: dict[tuple[int, int], int]):
    """Per batch and subtree, its rows as one row of binary columns; row numbers go along with the first tree."""
    types = dict(tree=pa.int32(), unit=pa.int64(), salt=pa.int64(), block=pa.int64(), places=pa.binary(), ids=pa.binary(), x=pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        unit_of, task = _unit_of(tops), TaskContext.get().partitionId()
        for number, batch in enumerate(b for b in batches if b.num_rows):
            ids, x = batch.column(0).to_numpy(), _values(batch, p)
            for t, units in unit_of(x):
                out = []
                order = np.argsort(units, kind="stable")
                for at in np.split(order, 1 + np.flatnonzero(np.diff(units[order]))):
                    u = int(units[at[0]])
                    # blocks take turns among the tasks that hold a copy, each task's from another start
                    salt = (number + 7 * task) % copies.get((t, u), 1)
                    out.append((t, u, salt, (task << 32) + number, at.astype(np.int32).tobytes(), ids[at].tobytes() if t == 0 else None, np.ascontiguousarray(x[:, at]).tobytes()))
                yield _batch(out, **types)

    return run


def _tree_of(feature: bytes, value: bytes, left: bytes) -> Tree:
    return Tree(np.frombuffer(feature, np.int32), np.frombuffer(value, np.float64), np.frombuffer(left, np.int64))


def _guess(top: Top, own: dict[int, tuple], x: np.ndarray) -> np.ndarray:
    if set(own) == {-1}:
        return _tree_of(*own[-1]).predict(x)
    unit = np.array(top.unit, np.int64)[top.as_tree().nodes_of(x)]
    out = np.zeros(x.shape[1])
    for k in np.unique(unit).tolist():
        rows = np.flatnonzero(unit == k)
        out[rows] = _tree_of(*own[k]).predict(x[:, rows])
    return out


@dataclass
class LaidOut:
    """A packed table with what every growth over it needs."""

    table: DataFrame
    n: int
    p: int
    scale: float
    quantiles: list[np.ndarray]
    cells: int


def lay_out(df: DataFrame, features: list[str], label: str, key: str, fold: str | None = None, cells: int = CELLS) -> LaidOut:
    if not features:
        raise ValueError("no features")
    table = packed(df, features, label, key, fold)
    n, top = table.agg(F.sum("n"), F.max("top")).first()
    if not n:
        raise ValueError("no rows to fit")
    p = len(features)
    quantiles: list[np.ndarray] = []
    if n * share_of(p) > cells:
        quantiles = cut_points(table, n, p)
    return LaidOut(table, n, p, label_scale(n, top), quantiles, cells)


def _grown(laid: LaidOut, specs: list[TreeSpec], task, schema: str, guesses: bool) -> tuple[list[Top], list[Unit], DataFrame]:
    """``task`` over the rows of every unit; the tops and units come with it. Without ``guesses`` only the rows that a tree grows on."""
    tops = _grow_tops(laid.table, specs, laid.n, laid.p, laid.scale, laid.quantiles, laid.cells)
    whole = laid.n * share_of(laid.p) <= laid.cells
    units = _units(specs, tops, laid.table.sparkSession.sparkContext.defaultParallelism, whole)
    parts = _rows_of_units(laid.table, units, tops, laid.p, whole, None if guesses else specs)
    return tops, units, parts.groupBy("unit", "salt").applyInArrow(task(units, specs, tops, laid.p, laid.scale), schema)


def fit_laid_out(laid: LaidOut, forest: Forest, features: list[str]) -> ForestModel:
    tops, units, subtrees = _grown(laid, tree_specs(forest, laid.p), _to_subtrees, _SUBTREE, False)
    # leaves of the tops need no rows: as many as the tops, which are at the driver, have
    leaves = [(u.trees[0], k, 1, _INT.pack(LEAF), _DOUBLE.pack(u.value / laid.scale), _LONG.pack(0)) for k, u in enumerate(units) if u.value is not None]
    if leaves:
        ended = laid.table.sparkSession.createDataFrame([tuple(bytearray(v) if isinstance(v, bytes) else v for v in r) for r in leaves], _SUBTREE)
        subtrees = ended if len(leaves) == len(units) else subtrees.unionByName(ended)
    subtrees = stored(subtrees)
    params = {k: getattr(forest, k) for k in ("n_estimators", "max_features", "bootstrap", "max_depth", "min_leaf", "seed")}
    return ForestModel(tuple(features), tops, subtrees, params)


def fit_forest(df: DataFrame, features: list[str], label: str, key: str, forest: Forest | None = None, cells: int = CELLS) -> ForestModel:
    """Grow ``forest`` on ``df``. ``key`` names the rows: bootstrap weights hang on it, so equal keys get equal weights."""
    features = list(features)
    return fit_laid_out(lay_out(df, features, label, key, None, cells), forest or Forest(), features)


def cross_validated(laid: LaidOut, candidates: list[Forest], folds: list[int]) -> DataFrame:
    """(candidate, fold, test, n, sse, sae, sy, syy) of every candidate without every fold, all grown together.

    Candidates that differ in nothing but the number of trees share them: the
    first trees of the larger forest are the smaller one.
    """
    families: dict[Forest, list[int]] = {}
    for k, c in enumerate(candidates):
        families.setdefault(replace(c, n_estimators=0), []).append(k)
    specs: list[TreeSpec] = []
    groups: list[tuple[int, dict[int, int]]] = []  # per family and fold: fold, {number of trees: candidate}
    owner: list[int] = []
    sizes: list[dict[int, list[int]]] = []
    for family, members in families.items():
        wanted: dict[int, list[int]] = {}
        for k in members:
            wanted.setdefault(int(candidates[k].n_estimators), []).append(k)
        for f in folds:
            own = tree_specs(replace(family, n_estimators=max(wanted)), laid.p, f)
            owner += [len(groups)] * len(own)
            specs += own
            groups.append((f, wanted))
            sizes.append(wanted)
    _, _, guesses = _grown(laid, specs, _to_guesses, _GUESS, True)
    name = F.element_at(F.array(*[F.lit(g) for g in owner]), F.col("tree") + 1) if len(owner) < 1000 else None
    if name is None:
        spark = laid.table.sparkSession
        names = spark.createDataFrame(list(enumerate(owner)), "tree int, family int")
        guesses = guesses.join(F.broadcast(names), "tree")  # one row a tree
    else:
        guesses = guesses.withColumn("family", name.cast("int"))
    numbers = [s.number for s in specs]
    schema = pa.schema([("candidate", pa.int32()), ("fold", pa.int32()), ("test", pa.bool_()), ("n", pa.int64()), *[(c, pa.float64()) for c in ("sse", "sae", "sy", "syy")]])

    def sums(parts: pa.Table) -> pa.Table:
        fold, wanted = groups[parts["family"][0].as_py()]
        rows = sorted(((numbers[t], k) for k, t in enumerate(parts["tree"].to_pylist())))
        at_of = [np.frombuffer(x.as_buffer(), np.int32) if x.is_valid else np.arange(len(g.as_buffer()) // 8) for x, g in zip(parts["places"], parts["guess"], strict=True)]
        n = 1 + max(int(a.max()) for a in at_of)
        total, y, test = np.zeros(n), np.zeros(n), np.zeros(n, bool)
        out = []
        for at, (number, k) in enumerate(rows):
            places = at_of[k]
            total[places] += np.frombuffer(parts["guess"][k].as_buffer(), np.float64)
            if number == 0:
                y[places] = np.frombuffer(parts["y"][k].as_buffer(), np.float64)
                test[places] = np.frombuffer(parts["fold"][k].as_buffer(), np.int32) == fold
            if at + 1 == len(rows) or rows[at + 1][0] != number:
                for c in wanted.get(number + 1, []):
                    off = y - total / (number + 1)
                    for side in (True, False):
                        own, lab = off[test == side], y[test == side]
                        out.append((c, fold, side, len(own), float(own @ own), float(np.abs(own).sum()), float(lab.sum()), float(lab @ lab)))
        return pa.table([list(c) for c in zip(*out, strict=True)], schema=schema)

    text = "candidate int, fold int, test boolean, n long, sse double, sae double, sy double, syy double"
    per_block = guesses.groupBy("family", "block").applyInArrow(sums, text)
    return per_block.groupBy("candidate", "fold", "test").agg(*[F.sum(c).alias(c) for c in ("n", "sse", "sae", "sy", "syy")])
