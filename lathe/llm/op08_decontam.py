"""Benchmark decontamination: n-gram seeds find candidate passages, Smith-Waterman scores them.

1. Every run of ``seed_words`` words of a test item is a seed (a shorter item is
   one seed, whole). One pass over all texts lists where seeds occur.
2. Occurrences join the items' seeds, every one however frequent: which seeds
   an edited copy keeps can't be told from counts. Those of one item on nearby
   diagonals make a window of the text, at most three times as long as the item.
3. A window that holds too few of its item's words for ``at_least``, were all
   of them matched, is left out; no pair is lost by that.
4. Each other window is aligned with its item, word by word, by Smith-Waterman
   (match 2, mismatch and gap -1), so copies with words changed, lost or put in
   score high. ``score`` is the best local score over that of a full match, of
   the item or, for long items, of ``full_words`` words. A copy that keeps no
   seed (every third word changed, say) is not found.

Items are taken in blocks of ``block_words`` words, one pass over the texts per
block, so what is broadcast is bounded. Null or empty texts and items have no
seeds and match nothing; rows are told apart by id, those without one by a hash
of their text (``leaks`` gives them a null id). Items of one id with different
texts are all searched, and a pair has the best score of them; equal ones are one.
Empty tables give an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lathe.llm.common import BROADCAST_ROWS, arrow_batches, blocks, cut, only, small_enough, texts_of
from lathe.llm.words import U, Words, join_hashes, ngrams

MATCH, OTHER, GAP = 2, -1, -1
#: Cells of one row of alignments that are filled together.
CELLS = 1 << 19
BITS = 20
FOUND = "id long, noid boolean, item long, start long, end long, raw long, words long"


def _key(id_col: str, text_col: str) -> list[Column]:
    """(id, noid): what a row is told apart by, never null."""
    own = F.col(f"`{id_col}`").cast("long")
    return [F.coalesce(own, F.xxhash64(F.col(f"`{text_col}`"))), own.isNull()]


def _seeds_of(h: np.ndarray, size: int) -> np.ndarray:
    return join_hashes(h, size) if len(h) >= size else join_hashes(h, len(h)) if len(h) else np.zeros(0, U)


def _occurrences(seeds: np.ndarray, sizes: list[int]):
    flag = np.zeros(1 << BITS, bool)
    flag[(seeds >> U(64 - BITS)).astype(np.int64)] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids, noid = texts_of(batch), *(batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            for lo, hi in blocks(texts):
                words = Words(texts[lo:hi])
                h = words.hashes()
                for size in sizes:
                    got, at = ngrams(h, words.off, size)
                    near = np.flatnonzero(flag[(got >> U(64 - BITS)).astype(np.int64)])
                    got, at = got[near], at[near]
                    found = seeds[np.minimum(np.searchsorted(seeds, got), len(seeds) - 1)] == got
                    got, at = got[found], at[found]
                    if len(got):
                        doc = np.searchsorted(words.off, at, "right") - 1
                        yield pa.RecordBatch.from_arrays([pa.array(ids[lo:hi][doc]), pa.array(noid[lo:hi][doc]), pa.array(got.view(np.int64)), pa.array((at - words.off[doc]).astype(np.int64))], names=["id", "noid", "seed", "at"])

    return run


def align(items: list[np.ndarray], windows: list[np.ndarray]) -> np.ndarray:
    """Best local alignment score of each item with its window; rows of the matrix are filled for many pairs at once."""
    best = np.zeros(len(items), np.int32)
    order = np.argsort([len(w) * 4096 + min(len(i), 4095) for i, w in zip(items, windows, strict=True)], kind="stable")
    at = 0
    while at < len(order):
        to = at + 1
        while to < len(order) and (to + 1 - at) * (len(windows[order[to]]) + 1) <= CELLS:
            to += 1
        part = order[at:to]
        at = to
        rows, cols = max(len(items[k]) for k in part), max(len(windows[k]) for k in part)
        text = np.zeros((len(part), cols), U)
        item = np.zeros((len(part), rows), U)
        real = np.zeros((len(part), cols), bool)
        for j, k in enumerate(part):
            text[j, : len(windows[k])], item[j, : len(items[k])] = windows[k], items[k]
            real[j, : len(windows[k])] = True
        lens = np.array([len(items[k]) for k in part])
        step = -GAP * np.arange(cols + 1, dtype=np.int32)
        row = np.zeros((len(part), cols + 1), np.int32)
        top = np.zeros(len(part), np.int32)
        for i in range(rows):
            same = (text == item[:, i : i + 1]) & real
            new = np.zeros_like(row)
            np.maximum(row[:, :-1] + np.where(same, MATCH, OTHER), row[:, 1:] + GAP, out=new[:, 1:])
            np.maximum(new, 0, out=new)
            row = np.maximum.accumulate(new + step, axis=1) - step
            top = np.where(i < lens, np.maximum(top, row.max(axis=1)), top)
        best[part] = top
    return best


def _may_score(item: np.ndarray, window: np.ndarray, full_words: int, at_least: float) -> bool:
    """Whether the score could be ``at_least``: a match needs one of the item's words that the window has."""
    return np.isin(item, window).sum() / min(len(item), full_words) >= at_least


def _aligned(shared, full_words: int, at_least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        for batch in batches:
            texts, ids, noid = texts_of(batch), batch.column(0).to_pylist(), batch.column(1).to_pylist()
            lists = batch.column(batch.schema.get_field_index("windows"))
            for lo, hi in blocks(texts):
                words = Words(texts[lo:hi])
                h = words.hashes()
                doc, bare, item, start, end, what, where = [], [], [], [], [], [], []
                for i, (a, b) in enumerate(zip(words.off[:-1], words.off[1:], strict=True)):
                    for w in lists[lo + i].as_py():
                        s, e = max(0, w["start"]), min(int(b - a), w["end"])
                        if not _may_score(items[w["item"]], h[a + s : a + e], full_words, at_least):
                            continue
                        doc.append(ids[lo + i])
                        bare.append(noid[lo + i])
                        item.append(w["item"])
                        start.append(s)
                        end.append(e)
                        what.append(items[w["item"]])
                        where.append(h[a + s : a + e])
                if doc:
                    raw = align(what, where)
                    yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(bare, pa.bool_()), pa.array(item, pa.int64()), pa.array(start, pa.int64()), pa.array(end, pa.int64()), pa.array(raw.astype(np.int64)), pa.array([len(x) for x in what], pa.int64())], names=["id", "noid", "item", "start", "end", "raw", "words"])

    return run


def _block(docs: DataFrame, items: dict[int, np.ndarray], seed_words: int, full_words: int, at_least: float) -> DataFrame:
    spark = docs.sparkSession
    rows = [(int(i), s, k, len(h)) for i, h in items.items() for k, s in enumerate(_seeds_of(h, seed_words).view(np.int64).tolist())]
    seeds = np.unique(np.array([r[1] for r in rows], np.int64).view(U))
    sizes = sorted({min(seed_words, len(h)) for h in items.values()})
    own = spark.createDataFrame(rows, "item long, seed long, pos long, words long")
    hits = cut(docs.mapInArrow(_occurrences(seeds, sizes), "id long, noid boolean, seed long, at long"))
    met = hits.join(F.broadcast(own) if len(rows) <= 200_000 else own, "seed").withColumn("diagonal", F.col("at") - F.col("pos"))
    windows = met.groupBy("id", "noid", "item", "words", F.floor(F.col("diagonal") / F.col("words")).alias("near")).agg(F.min("diagonal").alias("lo"), F.max("diagonal").alias("hi"))
    windows = windows.select("id", "noid", F.struct("item", (F.col("lo") - F.ceil(F.col("words") / 2)).alias("start"), (F.col("hi") + F.ceil(F.col("words") * 1.5)).alias("end")).alias("w"))
    windows = cut(windows.groupBy("id", "noid").agg(F.collect_list("w").alias("windows")))  # of one text: as many as its length and the items allow
    shared = spark.sparkContext.broadcast(items)
    return docs.join(small_enough(windows), ["id", "noid"]).select("id", "noid", "text", "windows").mapInArrow(_aligned(shared, full_words, at_least), FOUND)


def _found(documents: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str, item_text: str, seed_words: int, full_words: int, at_least: float, block_words: int) -> DataFrame:
    """(id, noid, item, b): the best window of each pair whose score is ``at_least`` that."""
    spark = documents.sparkSession
    arrow_batches(spark)
    key, noid = _key(id_col, text_col)
    docs = documents.select(key.alias("id"), noid.alias("noid"), F.col(f"`{text_col}`").alias("text"))
    test = only(benchmark, item=item_col, text=item_text).where("text is not null and item is not null").withColumn("n", F.length("text"))
    n_blocks = int((test.agg(F.sum("n")).first()[0] or 0) // (5 * block_words)) + 1
    out, out_cols = None, ["id", "noid", "item", "start", "end", "raw", "words"]
    for k in range(n_blocks):
        rows = test.where(F.pmod(F.xxhash64("item"), F.lit(n_blocks)) == k).select("item", "text").toPandas()
        items = {}
        if len(rows):
            words = Words(pa.array(rows["text"], pa.large_string()))
            h = words.hashes()
            # rows of one item with other words are searched each by itself
            texts = {(int(i), h[a:b].tobytes()): h[a:b] for i, a, b in zip(rows["item"], words.off[:-1], words.off[1:], strict=True) if b > a}
            items, owner = dict(enumerate(texts.values())), [i for i, _ in texts]
        if items:
            part = _block(docs, items, seed_words, full_words, at_least)
            names = spark.createDataFrame(list(enumerate(owner)), "item long, owner long")
            part = part.join(F.broadcast(names) if len(owner) <= BROADCAST_ROWS else names, "item").withColumn("item", F.col("owner")).drop("owner").select(*out_cols)
            out = part if out is None else out.union(part)
    if out is None:
        out = spark.createDataFrame([], FOUND)
    share = F.least(F.lit(1.0), F.col("raw") / (F.least("words", F.lit(full_words)) * float(MATCH)))
    return out.withColumn("score", share).where(F.col("score") >= at_least).groupBy("id", "noid", "item").agg(F.max(F.struct("score", -F.col("start"), -F.col("end"))).alias("b"))


def leaks(
    documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
    seed_words: int = 3, full_words: int = 32, at_least: float = 0.5, block_words: int = 1_000_000,
) -> DataFrame:
    """(id, item, score, word_from, word_to): pairs whose alignment score is ``at_least`` that, with the window's words."""
    best = _found(documents, benchmark, id_col, text_col, item_col, item_text, seed_words, full_words, at_least, block_words)
    return best.select(F.when(~F.col("noid"), F.col("id")).alias(id_col), F.col("item").alias(item_col), F.round("b.score", 6).alias("score"), (-F.col("b.col2")).alias("word_from"), (-F.col("b.col3")).alias("word_to"))


def decontaminated(
    documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
    seed_words: int = 3, full_words: int = 32, at_least: float = 0.5, block_words: int = 1_000_000,
) -> DataFrame:
    """The rows of ``documents`` with no passage of the benchmark."""
    found = _found(documents, benchmark, id_col, text_col, item_col, item_text, seed_words, full_words, at_least, block_words)
    bad = small_enough(cut(found.select(F.col("id").alias("_bad_id"), F.col("noid").alias("_bad_noid")).distinct()))
    key, noid = _key(id_col, text_col)
    return documents.join(bad, (key == F.col("_bad_id")) & (noid == F.col("_bad_noid")), "left_anti").select(*[F.col(f"`{c}`") for c in documents.columns])
