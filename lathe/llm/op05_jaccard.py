"""N-gram Jaccard join of whole texts: subsets for small sets, inverted lists for large ones.

Two texts link when their sets of word shingles have a Jaccard similarity of at
least ``percent`` / 100. The join is exact (up to 64-bit hash collisions of
shingles). Its steps, each a Spark job over the output of the one before:

1. ``shingle_table``: size and two content keys of every set. Sets with equal
   keys form a class, represented by its smallest id. The same pass counts
   shingles that repeat inside a buffer of texts; their sums rank the frequent
   ones. This rank orders shingles (rare first) and changes only the speed.
2. ``boundary``: over the small sets, the cost of enumerating subsets of each
   size against that of scanning inverted lists picks the size that divides
   small from large.
3. ``postings``: two sets that link share a shingle in their prefixes (the
   first ``n - ceil(t n) + 1`` in the order), and share ``SUBSET`` of them in
   prefixes that much longer. Two small sets meet by a subset of ``SUBSET``
   shingles; any other pair meets in an inverted list of single shingles.
   Lists of frequent shingles are salted.
4. ``meetings``: sorted by key, a key met once is dropped at once. The rest is
   a small table. In each list every member is paired with a pivot only (the
   member whose set has the fewest rarer shingles, per class of sizes).
5. Pairs are verified on the whole sets and contracted to components.
6. Lists that still hold several components are joined with themselves across
   components, so that no link between different components is missed.

Nulls and texts without words have empty sets and link with nothing. Ties and
repeated rows: rows are told apart by id, equal texts are one class. A row
without an id is counted, links with nothing and has a null component, so
``one_of_each`` keeps it. An empty table gives an empty result. Other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathe.llm.common import arrow_batches, blocks, cut, only, small_enough, texts_of
from lathe.llm.graph import components
from lathe.llm.words import MASK, U, Words, mix, shingle_sets

#: Shingles of a subset that two small sets share.
SUBSET = 2
#: Sets up to this size may count as small.
SMALL = 64
#: Shingles counted together before the repeated ones are passed on, and the repeats from which they are.
BUFFER, REPEATS = 2_000_000, 3
#: Frequent shingles that are ranked (a broadcast of 16 bytes each); the ranks of others don't matter.
RANKED = 200_000
#: Rows of a list that share a salt.
SALTED = 4096


def _least(n: np.ndarray | int, percent: int):
    """The fewest shingles that a set of n shares with any partner."""
    return (percent * n + 99) // 100


def _keys(s: np.ndarray) -> tuple[int, int]:
    if not len(s):
        return 0, 0
    return int(mix(s).sum(dtype=U).view(np.int64)), int(mix(s ^ U(0x5851F42D4C957F2D)).sum(dtype=U).view(np.int64))


TABLE = "id long, n long, k1 long, k2 long, small array<long>, shingle long, repeats long"


def _table(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        seen: set[tuple[int, int]] = set()
        total = 0
        schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("small", pa.list_(pa.int64())), ("shingle", pa.int64()), ("repeats", pa.int64())])

        def repeated() -> pa.RecordBatch:
            got, times = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, U), np.zeros(0, int))
            keep = times >= REPEATS
            none = pa.nulls(int(keep.sum()), pa.int64())
            return pa.RecordBatch.from_arrays([none, none, none, none, pa.nulls(len(none), pa.list_(pa.int64())), pa.array(got[keep].view(np.int64)), pa.array(times[keep])], schema=schema)

        for batch in batches:
            texts, ids = texts_of(batch), batch.column(0)
            for lo, hi in blocks(texts):
                sets = shingle_sets(Words(texts[lo:hi]), words)
                keys = [_keys(s) for s in sets]
                none = pa.nulls(hi - lo, pa.int64())
                yield pa.RecordBatch.from_arrays([
                    ids[lo:hi].cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()),
                    pa.array([s.view(np.int64) if 0 < len(s) <= SMALL else None for s in sets], pa.list_(pa.int64())), none, none], schema=schema)
                for s, k in zip(sets, keys, strict=True):
                    if len(s) and k not in seen:
                        seen.add(k)
                        held.append(s)
                        total += len(s)
                if total >= BUFFER:
                    yield repeated()
                    held, total = [], 0
                    seen.clear()
        yield repeated()

    return run


def shingle_table(docs: DataFrame, words: int = 5) -> DataFrame:
    """Rows of sets (id, n, keys, the set itself if small) and rows of repeated shingles, in one pass."""
    arrow_batches(docs.sparkSession)
    return cut(docs.mapInArrow(_table(words), TABLE))


def boundary(sets: DataFrame, percent: int) -> int:
    """The largest size whose sets are enumerated: least sum of subsets (small) and list entries scanned (large)."""
    small = sets.where("small is not null").select("id", "n", "small")
    need = F.ceil(F.col("n") * percent / 100)
    enumerated = small.groupBy("n").agg(F.count("*").alias("sets")).select("n", (F.col("sets") * (F.col("n") - need + SUBSET) * (F.col("n") - need + SUBSET - 1) / 2).alias("subsets"))
    lists = small.select("n", F.explode(F.slice("small", F.lit(1), (F.col("n") - need + 1).cast("int"))).alias("h")).groupBy("h", "n").agg(F.count("*").alias("c"))
    met = lists.groupBy("h").agg(F.sum("c").alias("df"))
    scanned = lists.join(met, "h").groupBy("n").agg(F.sum(F.col("c") * F.col("df")).alias("entries"))
    cost = {r.n: (float(r.subsets), float(r.entries or 0)) for r in enumerated.join(scanned, "n", "left").collect()}  # at most SMALL rows
    return min(range(SMALL + 1), key=lambda x: sum(cost[n][0] if n <= x else cost[n][1] for n in cost))


POSTING = "key long, salt int, id long, n long, pos int, small boolean"


def _ordered(s: np.ndarray, ranked: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The set in the global order, and how frequent each shingle is (0: not ranked)."""
    if not len(ranked) or not len(s):
        return s, np.zeros(len(s), np.int8)
    at = np.minimum(np.searchsorted(ranked, s), len(ranked) - 1)
    level = np.where(ranked[at] == s, rank[at], 0).astype(np.int8)
    if level.any():
        by = np.argsort(level, kind="stable")
        return s[by], level[by]
    return s, level


def _postings(words: int, percent: int, limit: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranked, rank = shared.value
        for batch in batches:
            texts, ids = texts_of(batch), batch.column(0).to_numpy(zero_copy_only=False)
            for lo, hi in blocks(texts):
                out: list[list[np.ndarray]] = [[], [], [], [], [], []]

                def put(key, salt, i, n, pos, small, out=out):
                    for column, x in zip(out, (key, salt, np.full(len(key), i), np.full(len(key), n), pos, np.full(len(key), small)), strict=True):
                        column.append(x)

                for i, s in zip(ids[lo:hi].tolist(), shingle_sets(Words(texts[lo:hi]), words), strict=True):
                    n = len(s)
                    if not n:
                        continue
                    s, level = _ordered(s, ranked, rank)
                    least = _least(n, percent)
                    if n > limit or n >= _least(limit + 1, percent):
                        p = n - least + 1
                        # a ranked list is 2**level long or so: enough salts for SALTED rows each
                        room = np.left_shift(np.int64(1), np.maximum(level[:p].astype(np.int64) - 12, 0))
                        salt = np.where(level[:p] > 12, 1 + (mix(np.full(p, i, np.int64).view(U)) >> U(33)).view(np.int64) % room, 0)
                        put(s[:p], salt, i, n, np.arange(p), False)
                    if 1 < n <= limit:
                        p = n - least + SUBSET
                        a, b = np.triu_indices(min(p, n), 1)
                        put(mix(s[a] * U(0x9E3779B97F4A7C15) ^ mix(s[b])), np.zeros(len(a), np.int64), i, n, a, True)
                if out[0]:
                    key, salt, i, n, pos, small = (np.concatenate(x) for x in out)
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(salt.astype(np.int32)), pa.array(i), pa.array(n), pa.array(pos.astype(np.int32)), pa.array(small)], names=["key", "salt", "id", "n", "pos", "small"])

    return run


MEETING = "key long, salt int, id long, n long, pos int, small boolean, pivot long, pivot_n long, pivot_pos int"


def _size_class(n: np.ndarray) -> np.ndarray:
    return (np.log2(np.maximum(n, 1)) * 4).astype(np.int64)


def _meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted postings -> those whose list has a second member, with the pivot of their list and size class.

    Only the first posting of a list and the pivot of a class are held, however long the list is."""
    last = None  # (key, salt, size class, pivot's id, n, pos) of the row before
    first = None  # the row before, while it is alone in its list
    for batch in batches:
        if not batch.num_rows:
            continue
        key, salt, cls, ids, n, pos = (batch.column(batch.schema.get_field_index(x)).to_numpy(zero_copy_only=False) for x in ("key", "salt", "cls", "id", "n", "pos"))
        rows = len(key)
        new_list = np.empty(rows, bool)
        new_list[1:] = (key[1:] != key[:-1]) | (salt[1:] != salt[:-1])
        new_list[0] = last is None or last[:2] != (key[0], salt[0])
        new_cls = new_list.copy()
        new_cls[1:] |= cls[1:] != cls[:-1]
        new_cls[0] |= last is not None and last[2] != cls[0]
        at = np.maximum.accumulate(np.where(new_cls, np.arange(rows), -1))
        held = last or (0, 0, 0, 0, 0, 0)
        pivot, pivot_n, pivot_pos = (np.where(at >= 0, x[np.maximum(at, 0)], held[3 + j]) for j, x in enumerate((ids, n, pos)))
        alone = new_list.copy()
        alone[:-1] &= new_list[1:]
        alone[-1] = False  # not known yet
        alone &= salt == 0  # other salts share the key
        keep = ~alone
        wait = bool(new_list[-1]) and salt[-1] == 0
        if wait:
            keep[-1] = False
        got = batch.select(["key", "salt", "id", "n", "pos", "small"])
        own = [pa.array(pivot.astype(np.int64)), pa.array(pivot_n.astype(np.int64)), pa.array(pivot_pos.astype(np.int32))]
        full = pa.RecordBatch.from_arrays([*got.columns, *own], names=[*got.schema.names, "pivot", "pivot_n", "pivot_pos"])
        if first is not None and not new_list[0]:
            yield first
        yield full.filter(pa.array(keep))
        if wait:
            first = full.slice(rows - 1)
        elif rows > 1 or not new_list[0]:
            first = None
        last = (key[-1], salt[-1], cls[-1], pivot[-1], pivot_n[-1], pivot_pos[-1])


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids = texts_of(batch), batch.column(0).cast(pa.int64())
            for lo, hi in blocks(texts):
                sets = shingle_sets(Words(texts[lo:hi]), words)
                yield pa.RecordBatch.from_arrays([ids[lo:hi], pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["id", "shingles"])

    return run


def _fits(a: str, b: str, percent: int):
    """Filters on sizes and positions that every linked pair meets: ``a``/``b`` prefix n and pos of its sides."""
    na, nb, pa_, pb = F.col(f"{a}n"), F.col(f"{b}n"), F.col(f"{a}pos"), F.col(f"{b}pos")
    need = F.ceil(F.lit(percent) * (na + nb) / F.lit(100 + percent))
    return (100 * F.least(na, nb) >= percent * F.greatest(na, nb)) & (F.least(na - pa_, nb - pb) >= need)


def _counted(pairs: DataFrame, met: DataFrame, limit: int, percent: int) -> DataFrame:
    """Pairs whose shared prefix shingles allow a link.

    A shingle that both sets have stands in both prefixes, or beyond the end of
    the prefix that ends first: so the overlap is at most the shared ones in the
    prefixes and the rest of one set. Two small sets meet by subsets and are left
    as they are."""
    keys = cut(met.where("not small").groupBy("id").agg(F.first("n").alias("n"), F.collect_set("key").alias("keys")))  # at most a prefix
    for side in "ab":
        pairs = pairs.join(keys.select(F.col("id").alias(side), F.col("n").alias(f"n{side}"), F.col("keys").alias(f"keys_{side}")), side, "left")
    need = F.ceil(F.lit(percent) * (F.col("na") + F.col("nb")) / F.lit(100 + percent))
    rest = F.ceil(F.lit(percent) * F.greatest("na", "nb") / F.lit(100)) - 1
    few = (F.greatest("na", "nb") > limit) & (F.size(F.array_intersect("keys_a", "keys_b")) + rest < need)
    return pairs.where(~F.coalesce(few, F.lit(False))).select("a", "b")


def _verified(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets link. Sets are made again from the texts, for the ids in pairs only."""
    ids = cut(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct())
    sets = cut(docs.join(small_enough(ids), "id", "left_semi").mapInArrow(_sets(words), "id long, shingles array<long>"))
    got = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa")), "a").join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb")), "b")
    both = F.size(F.array_intersect("sa", "sb"))
    return got.where(100 * both >= percent * (F.size("sa") + F.size("sb") - both)).select("a", "b")


def jaccard_components(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 75) -> DataFrame:
    """(id, n_shingles, component_id) of every row; see the module's text for the method."""
    spark = documents.sparkSession
    docs = only(documents, id=id_col, text=text_col)
    table = shingle_table(docs, words)
    docs = docs.where("id is not null")
    sets = table.where("shingle is null and id is not null").select("id", "n", "k1", "k2", "small")
    alone = table.where("shingle is null and id is null").select("id", F.col("n").alias("n_shingles"), F.col("id").alias("component_id"))
    classes = cut(sets.where("n > 0").groupBy("n", "k1", "k2").agg(F.min("id").alias("rep"), F.count("*").alias("copies")))
    repeats = table.where("shingle is not null").groupBy("shingle").agg(F.sum("repeats").alias("df")).orderBy(F.desc("df"), "shingle").limit(RANKED).toPandas()
    order = np.argsort(h := repeats["shingle"].to_numpy(np.int64).view(U))
    shared = spark.sparkContext.broadcast((h[order], (1 + np.log2(repeats["df"].to_numpy(np.float64)[order])).astype(np.int8)))

    member = cut(sets.where("n > 0").join(classes.where("copies > 1").drop("copies"), ["n", "k1", "k2"]).select("id", "rep"))
    copies = member.where("id <> rep").select("id")
    own = docs.join(small_enough(copies), "id", "left_anti")
    limit = boundary(sets.join(small_enough(copies), "id", "left_anti"), percent)
    arrow_batches(spark)
    listed = own.mapInArrow(_postings(words, percent, limit, shared), POSTING)
    cls = F.floor(F.log2(F.greatest("n", F.lit(1))) * 4).cast("int")
    met = cut(listed.withColumn("cls", cls).repartition("key", "salt").sortWithinPartitions("key", "salt", "cls", "pos", "n", "id").mapInArrow(_meetings, MEETING))

    def pair(x: str, y: str) -> list:
        return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]

    tried = met.where("id <> pivot").where(_fits("", "pivot_", percent)).select(*pair("id", "pivot")).distinct()
    # the pivots of a salted list meet among themselves, in a list of one row for each salt and class
    pivots = met.where("salt > 0 and id = pivot").select("key", F.struct("pos", "n", "id").alias("p"))
    tops = pivots.groupBy("key").agg(F.min("p").alias("top"))
    tried = cut(tried.union(pivots.join(tops, "key").where("p.id <> top.id and 100 * least(p.n, top.n) >= %d * greatest(p.n, top.n)" % percent).select(*pair("p.id", "top.id"))).distinct())
    links = cut(_verified(cut(_counted(tried, met, limit, percent)), own, words, percent))

    comp = components(links)
    met = cut(met.drop("pivot", "pivot_n", "pivot_pos").join(comp, "id", "left").withColumn("component", F.coalesce("component", "id")))
    open_ = met.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key")
    rest = met.join(open_, "key", "left_semi").select("key", "id", "n", "pos", "small", "component")
    x = rest.select("key", *[F.col(c).alias(f"x_{c}") for c in ("id", "n", "pos", "small", "component")])
    y = rest.select("key", *[F.col(c).alias(f"y_{c}") for c in ("id", "n", "pos", "small", "component")])
    across = x.join(y, "key").where("x_id < y_id and x_component <> y_component").where(_fits("x_", "y_", percent)).select(F.col("x_id").alias("a"), F.col("y_id").alias("b")).distinct()
    across = cut(_counted(across.join(tried, ["a", "b"], "left_anti"), met, limit, percent))
    more = cut(_verified(across, own, words, percent))
    comp = components(links.union(more))

    rep = member.select("id", "rep")
    return (
        sets.select("id", "n").join(rep, "id", "left").withColumn("rep", F.coalesce("rep", "id"))
        .join(comp.withColumnRenamed("id", "rep"), "rep", "left")
        .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id"))
        .union(alone)
    )


def one_of_each(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 75) -> DataFrame:
    """``documents`` without the rows whose component has a smaller id."""
    dropped = jaccard_components(documents, id_col, text_col, words, percent).where(F.col(id_col) > F.col("component_id")).select(id_col)
    return documents.join(small_enough(cut(dropped.distinct())), id_col, "left_anti").select(*[F.col(f"`{c}`") for c in documents.columns])
