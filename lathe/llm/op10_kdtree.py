"""Shards of near equal bytes by a k-d tree over metadata; DataFrame functions only.

All rows begin in one node. A node that is to become k shards is split where the
lower part holds k // 2 / k of its bytes, along the dimension in which the node
is widest (as a share of the whole table's width), until every node is one
shard. Rows equal in that dimension are ordered by a hash of their id, so a value
that a third of all rows share is split like any other.

All nodes of a level are split together. Their weighted medians come from
histograms of a slim table (id, size, one 62-bit key per dimension: value, then
hash), each round narrowing a node's interval to one of ``BINS`` parts, until what
is undecided is a few thousandths of a shard. Only sums per node and bin reach
the driver, as many as shards and bins. Places inside a shard are numbered in
hashed parts, whose offsets are summed up first.

A size is the text's UTF-8 bytes (null: none) plus ``EXTRA``. Null metadata is the
lowest value. Rows with equal ids and metadata stay together. An empty table
gives an empty result; with fewer rows than shards, some shards stay empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lathe.llm.common import cut, small_enough, unit

EXTRA, BINS = 16, 512
#: Of a key of 62 bits, those of the value and those of the hash.
BITS = 31
PART_ROWS = 4096


def _array(values: list[int]) -> Column:
    return F.expr("array(" + ",".join(f"{int(v)}L" for v in values) + ")")


def _keys(docs: DataFrame, dims: dict[str, Column], id_col: str) -> tuple[DataFrame, int]:
    slim = docs.select(F.col(f"`{id_col}`").alias("id"), (F.coalesce(F.octet_length("_text"), F.lit(0)) + EXTRA).cast("long").alias("size"), F.crc32(F.coalesce("_text", F.lit("")).cast("binary")).alias("crc"), *[d.cast("double").alias(f"v{k}") for k, d in enumerate(dims.values())])
    slim = cut(slim)
    ends = slim.agg(F.count("*").alias("n"), F.sum("size").alias("bytes"), *[f(f"v{k}").alias(f"{f.__name__}{k}") for k in range(len(dims)) for f in (F.min, F.max)]).first()
    tie = F.shiftrightunsigned(F.xxhash64("id"), 64 - BITS)
    keys = []
    for k in range(len(dims)):
        lo, width = ends[f"min{k}"] or 0.0, (ends[f"max{k}"] or 0.0) - (ends[f"min{k}"] or 0.0)
        scaled = F.floor((F.coalesce(F.col(f"v{k}"), F.lit(lo)) - lo) / (width or 1.0) * float((1 << BITS) - 1)).cast("long")
        keys.append((F.shiftleft(scaled, BITS) + tie).alias(f"k{k}"))
    return slim.select("id", "size", "crc", *keys), ends["n"]


def _next_node(rows: DataFrame, level: tuple[list[int], ...], dims: int) -> DataFrame:
    """Every row's node, one level down."""
    dim, cut_at, left, right = level
    at = F.col("node") + 1
    here = F.element_at(F.array(*[F.col(f"k{k}") for k in range(dims)]), F.element_at(_array(dim), at).cast("int") + 1)
    return rows.withColumn("node", F.when(here < F.element_at(_array(cut_at), at), F.element_at(_array(left), at)).otherwise(F.element_at(_array(right), at)).cast("int"))


def _medians(rows: DataFrame, wanted: dict[int, tuple[int, int, int, float]], target: float) -> dict[int, int]:
    """For each node (dimension, lowest, highest key, bytes of the lower part) the key at which the upper part begins."""
    size = max(wanted) + 1
    lo = {n: w[1] for n, w in wanted.items()}
    hi = {n: w[2] + 1 for n, w in wanted.items()}
    below = dict.fromkeys(wanted, 0)
    found: dict[int, int] = {}
    keys = F.array(*[F.col(c) for c in rows.columns if c.startswith("k")])
    while len(found) < len(wanted):
        open_ = [n for n in wanted if n not in found]
        step = {n: max(1, -(-(hi[n] - lo[n]) // BINS)) for n in open_}
        at = F.col("node") + 1
        dim, low, high, each = (F.element_at(_array([v.get(n, w) for n in range(size)]), at) for v, w in (({n: wanted[n][0] for n in open_}, -1), ({n: lo[n] for n in open_}, 0), ({n: hi[n] for n in open_}, 0), (step, 1)))
        key = F.element_at(keys, dim.cast("int") + 1)
        inside = rows.where((F.col("node") < size) & (dim >= 0)).withColumns({"_k": key, "_lo": low, "_hi": high, "_step": each}).where("_k >= _lo and _k < _hi")
        sums = inside.groupBy("node", F.expr("(_k - _lo) div _step").alias("bin")).agg(F.sum("size").alias("b")).collect()
        by: dict[int, list[tuple[int, int]]] = {n: [] for n in open_}
        for r in sums:
            by[r.node].append((r.bin, r.b))
        for n in open_:
            want, total = wanted[n][3], below[n]
            for k, b in sorted(by[n]):
                if total + b >= want:
                    break
                total += b
            else:
                found[n] = hi[n]
                continue
            left, right = lo[n] + k * step[n], min(lo[n] + (k + 1) * step[n], hi[n])
            if step[n] == 1 or b <= target / 1000:
                found[n] = left if want - total <= total + b - want else right
            else:
                lo[n], hi[n], below[n] = left, right, total
    return found


def shards(documents: DataFrame, dims: dict[str, Column] | None = None, n_shards: int | None = None, target_bytes: int = 1 << 30, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, shard, slot) of every row; ``n_shards``, or as many as give ``target_bytes`` each."""
    docs = documents.withColumn("_text", F.col(f"`{text_col}`"))
    if dims is None:
        dims = {"size": F.log2(F.coalesce(F.octet_length("_text"), F.lit(0)) + EXTRA), "id": F.col(f"`{id_col}`")}
        dims |= {c: unit(F.col(f"`{c}`"), "dim") for c in ("source", "lang") if c in documents.columns}
    slim, n_rows = _keys(docs, dims, id_col)
    rows = cut(slim.withColumn("node", F.lit(0)))
    total = rows.agg(F.sum("size")).first()[0] or 0
    n_shards = n_shards or max(1, -(-total // target_bytes))
    target = total / n_shards
    nodes = [(0, n_shards)]  # first shard, shards
    whole: list[int] = []
    while n_rows and any(k > 1 for _, k in nodes):
        ends = {r.node: r for r in rows.groupBy("node").agg(F.sum("size").alias("bytes"), *[f(f"k{k}").alias(f"{f.__name__}{k}") for k in range(len(dims)) for f in (F.min, F.max)]).collect()}
        whole = whole or [max(1, ends[0][f"max{k}"] - ends[0][f"min{k}"]) for k in range(len(dims))]
        wanted, widest = {}, {}
        for i, (_, k) in enumerate(nodes):
            if k > 1 and i in ends:
                d = max(range(len(dims)), key=lambda d, e=ends[i]: ((e[f"max{d}"] - e[f"min{d}"]) / whole[d], -d))
                widest[i] = d
                wanted[i] = (d, ends[i][f"min{d}"], ends[i][f"max{d}"], ends[i]["bytes"] * (k // 2) / k)
        at = _medians(rows, wanted, target) if wanted else {}
        new: list[tuple[int, int]] = []
        level: tuple[list[int], ...] = ([], [], [], [])
        for i, (first, k) in enumerate(nodes):
            for x, v in zip(level, (widest.get(i, 0), at.get(i, 0), len(new), len(new) + (k > 1)), strict=True):
                x.append(v)
            new += [(first, k // 2), (first + k // 2, k - k // 2)] if k > 1 else [(first, 1)]
        rows = cut(_next_node(rows, level, len(dims)))
        nodes = new
    rows = rows.select("id", "size", "crc", F.element_at(_array([f for f, _ in nodes]), F.col("node") + 1).cast("int").alias("shard"))
    parts = max(1, n_rows // (n_shards * PART_ROWS))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(parts)))
    counts = cut(rows.groupBy("shard", "part").agg(F.count("*").alias("c")))
    before = counts.withColumn("before", F.sum("c").over(Window.partitionBy("shard").orderBy("part")) - F.col("c")).drop("c")
    own = F.row_number().over(Window.partitionBy("shard", "part").orderBy(F.xxhash64("id"), "id", "crc")) - 1
    placed = rows.withColumn("own", own).join(small_enough(before), ["shard", "part"])
    return placed.select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard", (F.col("own") + F.col("before")).cast("long").alias("slot"))
