"""Merkle manifest of a dataset, with a witness for every row that grows while its tree does.

Rows are leaves: the digest of their columns. Leaves of a group stand in the
order of an id; while several nodes remain, every two consecutive ones become
the digest of both (a last odd one the digest of itself). What remains is the
group's subroot; the subroots, in the order of their groups, make the root.

Witnesses are built as leaves are appended. An ``Appender`` holds the open
subtrees, at most one of each size, each with its leaves' partial witnesses.
A new leaf that completes a sibling extends the witnesses of both sides by
the other's digest and joins the two, as often as sizes are equal. On Spark,
every aligned block of 2^12 leaves is appended by one task; the block's root
is then a leaf of the next round, whose witness extends those of all its
leaves, until one node is left. So no task sees more than one block of a
group at a time, however large the group, and the rounds grow with the
logarithm of the rows to the base 4,096.

Positions come from a sort by range: rows per group and partition are counted
and added up, so no window runs over a whole group.

The order is nulls first, then ascending (strings by UTF-8 bytes), ties by
leaf digest; equal rows are leaves of their own with equal digests. Null
values are leaves' parts too (``-``), so no value equals them; empty texts are
``0:``. Long texts are read once, by the digest. Other columns are not read. An empty table gives an
empty result. Tables written to the shared folder are left to the caller.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lathe.llm.common import arrow_batches, cut, only, small_enough

#: Levels of a block: one task appends 2^12 leaves before it hands on a root.
BLOCK_LEVELS = 12


def part(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*values: Column) -> Column:
    """SHA-256 of the parts in their order, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*map(part, values)), 256))


def joined(*digests: bytes) -> bytes:
    """Digest of digests: over their lower-case hexadecimal texts."""
    return hashlib.sha256("".join([d.hex() for d in digests]).encode()).digest()


def height(n: int) -> int:
    """Levels above ``n`` leaves."""
    return max(n - 1, 0).bit_length()


class Appender:
    """Leaves in order; open subtrees as (level, first leaf, digest), the largest first."""

    def __init__(self, levels: int = BLOCK_LEVELS) -> None:
        self.n = 0
        self.open: list[tuple[int, int, bytes]] = []
        self.sibling = np.zeros((1 << levels, levels, 32), np.uint8)
        self.known = np.zeros((1 << levels, levels), bool)

    def _witness(self, lo: int, hi: int, level: int, digest: bytes) -> None:
        self.sibling[lo:hi, level] = np.frombuffer(digest, np.uint8)
        self.known[lo:hi, level] = True

    def _complete(self, level: int, lo: int, digest: bytes) -> tuple[int, int, bytes]:
        """The open subtree of this level and the new one extend each other's witnesses and become one."""
        _, first, left = self.open.pop()
        self._witness(first, lo, level, digest)
        self._witness(lo, self.n, level, left)
        return level + 1, first, joined(left, digest)

    def append(self, digest: bytes) -> None:
        node = (0, self.n, digest)
        self.n += 1
        while self.open and self.open[-1][0] == node[0]:
            node = self._complete(*node)
        self.open.append(node)

    def close(self, levels: int) -> bytes:
        """The digest at ``levels``: the last open subtree goes up, alone where it has no sibling."""
        level, lo, digest = self.open.pop()
        while level < levels:
            if self.open and self.open[-1][0] == level:
                level, lo, digest = self._complete(level, lo, digest)
            else:
                level, digest = level + 1, joined(digest)
        return digest

    def witnesses(self) -> list[bytes]:
        """Each leaf's siblings so far, from the lowest level on."""
        full = self.known[: self.n].all(axis=1).tolist()
        return [self.sibling[k].tobytes() if full[k] else self.sibling[k][self.known[k]].tobytes() for k in range(self.n)]


def fold(digest: bytes, at: int, n: int, siblings: bytes) -> bytes:
    """The digest that leaf ``at`` of ``n`` leads to with these siblings."""
    used = 0
    while n > 1:
        if at ^ 1 < n:
            other = siblings[used : used + 32]
            used += 32
            digest = joined(other, digest) if at & 1 else joined(digest, other)
        else:
            digest = joined(digest)
        at, n = at >> 1, n + 1 >> 1
    return digest


def positions(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (with ``_group``) with ``_at``, the place in the group by ``order``, and ``_n``, the group's rows."""
    keys = ["_group", *order]
    laid = cut(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("*", F.monotonically_increasing_id().alias("_row")))
    run = [F.col("_group"), F.shiftright("_row", 33).alias("_run")]
    runs = laid.groupBy(*run).agg(F.min("_row").alias("_first"), F.count("*").alias("_rows"))
    group = Window.partitionBy("_group")  # one row for each partition that holds the group
    before = F.sum("_rows").over(group.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select(F.col("_group").alias("_g"), F.col("_run").alias("_r"), (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_rows").over(group).alias("_n"))
    found = laid.join(small_enough(runs), F.col("_group").eqNullSafe(F.col("_g")) & (F.shiftright("_row", 33) == F.col("_r")))
    return found.select(*rows.columns, (F.col("_row") + F.col("_shift")).alias("_at"), "_n")


def _append_blocks(levels: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []  # rows of the block that is open
        now = None

        def done() -> pa.RecordBatch:
            rows = pa.Table.from_batches(kept).combine_chunks().to_batches()[0]
            n = rows.column(names.index("_n"))[0].as_py()
            tree = Appender(levels)
            for digest in rows.column(names.index("_digest")).to_pylist():
                tree.append(digest)
            root = tree.close(levels if n > 1 << levels else height(n))
            roots = pa.array([root] + [None] * (tree.n - 1), pa.binary())
            return pa.RecordBatch.from_arrays([*rows.columns, pa.array(tree.witnesses(), pa.binary()), roots], names=[*names, "_witness", "_root"])

        for batch in batches:
            if not batch.num_rows:
                continue
            names = batch.schema.names
            place = np.asarray(batch.column(names.index("_at"))) >> levels
            groups = batch.column(names.index("_group")).to_pylist()
            new = [0] + [k for k in range(1, len(place)) if place[k] != place[k - 1] or groups[k] != groups[k - 1]] + [len(place)]
            for lo, hi in zip(new[:-1], new[1:], strict=True):
                key = (groups[lo], int(place[lo]))
                if kept and key != now:
                    yield done()
                    kept.clear()
                now = key
                kept.append(batch.slice(lo, hi - lo))
        if kept:
            yield done()

    return run


def _with_block(nodes: DataFrame, levels: int) -> DataFrame:
    """``nodes`` (_group, _at, _n, _digest, ...) with the witness inside their block; the block's root stands at its first node."""
    block = F.shiftright("_at", levels)
    schema = nodes.schema.add("_witness", "binary").add("_root", "binary")
    return cut(nodes.repartition("_group", block).sortWithinPartitions("_group", "_at").mapInArrow(_append_blocks(levels), schema))


def witnessed(leaves: DataFrame, order: list[str], levels: int = BLOCK_LEVELS) -> tuple[DataFrame, DataFrame]:
    """``leaves`` (_group, _digest, order columns) with place ``_at`` of ``_n`` and whole ``_witness``; and (_group, _digest) of the subroots."""
    arrow_batches(leaves.sparkSession)
    rounds = [_with_block(positions(leaves, order), levels)]
    while True:
        roots = rounds[-1].where("_root is not null")
        most = roots.agg(F.max("_n")).first()[0]
        up = roots.select("_group", F.shiftright("_at", levels).alias("_at"), F.shiftright(F.col("_n") + (1 << levels) - 1, levels).alias("_n"), F.col("_root").alias("_digest"))
        if most is None or most <= 1 << levels:
            break
        rounds.append(_with_block(up, levels))
    out = rounds.pop()
    while rounds:
        # the witness of a block's root goes to all its leaves
        upper = out.select(F.col("_group").alias("_g"), F.col("_at").alias("_b"), F.col("_witness").alias("_more"))
        below = rounds.pop()
        met = below.join(small_enough(upper), F.col("_group").eqNullSafe(F.col("_g")) & (F.shiftright("_at", levels) == F.col("_b")))
        out = met.withColumn("_witness", F.concat("_witness", "_more")).drop("_g", "_b", "_more")
    return out.drop("_root"), up.select("_group", "_digest")


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        proof, folded = [], []
        col = {name: batch.column(k).to_pylist() for k, name in enumerate(batch.schema.names)}
        for start, at, n, inner, place, groups, outer in zip(*[col[c] for c in ("_start", "_at", "_n", "_witness", "_place", "_groups", "_outer")], strict=True):
            proof.append(hashlib.sha256((inner.hex() + outer.hex()).encode()).hexdigest())
            folded.append(fold(fold(start, at, n, inner), place, groups, outer))
        keep = [k for k, name in enumerate(batch.schema.names) if name in ("id", "_digest", "_subroot", "_top")]
        yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in keep], pa.array(proof), pa.array(folded, pa.binary())], names=["id", "leaf", "subroot", "root", "proof_sha256", "folded"])


def manifest(leaves: DataFrame, levels: int = BLOCK_LEVELS) -> tuple[DataFrame, DataFrame]:
    """``leaves`` (id, _group, _digest, ...) -> the same with witnesses; and a table of groups.

    Rows: ``_at`` of ``_n`` in the group, ``_witness``. Groups: ``_group``,
    ``_subroot``, ``_place`` of ``_groups``, ``_outer`` (the subroot's
    witness) and ``_top``, the root.
    """
    rows, subroots = witnessed(leaves, ["id", "_digest"], levels)
    # the groups are leaves of one tree more, ordered by their name
    named = subroots.select(F.lit(0).alias("_group"), F.col("_group").alias("_name"), "_digest")
    groups, top = witnessed(named, ["_name"], levels)
    groups = groups.select(F.col("_name").alias("_g"), F.col("_digest").alias("_subroot"), F.col("_at").alias("_place"), F.col("_n").alias("_groups"), F.col("_witness").alias("_outer"))
    return rows, groups.crossJoin(F.broadcast(top.select(F.col("_digest").alias("_top"))))  # one row


def proofs(leaves: DataFrame, levels: int = BLOCK_LEVELS) -> DataFrame:
    """``leaves`` (id, _group, _digest, _start) -> (id, leaf, subroot, root, proof_sha256, folded), digests as bytes.

    ``folded`` is what ``_start`` (the digest of the row as found, say, after
    tampering) leads to with the leaf's own siblings.
    """
    rows, groups = manifest(leaves, levels)
    met = rows.join(small_enough(groups), F.col("_group").eqNullSafe(F.col("_g")))
    kind = leaves.select("id").schema[0].dataType.simpleString()
    cols = ["id", "_digest", "_subroot", "_top", "_start", "_at", "_n", "_witness", "_place", "_groups", "_outer"]
    return met.select(*cols).mapInArrow(_fold, f"id {kind}, leaf binary, subroot binary, root binary, proof_sha256 string, folded binary")


def document_proofs(documents: DataFrame, levels: int = BLOCK_LEVELS) -> DataFrame:
    """Proof of every document in the manifest by language, folded from rows of which some are tampered with.

    Where 7 divides the CRC-32 of the decimal id, the row as found has 1 more
    in ``n_chars`` (a null id or a null ``n_chars`` stays).
    """
    docs = only(documents, id="doc_id", source="source", lang="lang", n="n_chars", text="text")
    found = (F.crc32(F.col("id").cast("string").cast("binary")) % 7 == 0) & F.col("n").isNotNull()
    digest = leaf_digest(F.col("id"), F.col("source"), F.col("lang"), F.col("n"), F.col("text"))
    tampered = leaf_digest(F.col("id"), F.col("source"), F.col("lang"), F.col("n") + 1, F.col("text"))
    leaves = docs.select("id", F.col("lang").alias("_group"), digest.alias("_digest"), F.when(found, tampered).alias("_start"))
    leaves = leaves.withColumn("_start", F.coalesce("_start", "_digest"))
    got = proofs(leaves, levels)
    text = {c: F.lower(F.hex(c)) for c in ("leaf", "subroot", "root")}
    return got.select(F.col("id").alias("doc_id"), *[v.alias(k) for k, v in text.items()], "proof_sha256", F.lower(F.hex("folded")).alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))
