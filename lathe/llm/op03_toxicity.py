"""Toxicity by non-negative positive-unlabelled learning.

Learns from confirmed toxic texts and unlabelled ones, of which a share
``prior`` is toxic as well. A text's features are its distinct lower-cased words of
letters and their beginnings of 4 to 6 bytes. Features much more frequent in
the toxic sample than in the unlabelled one are kept; a linear model over them
minimises

    prior * E_toxic[loss(+)] + max(0, E_unlabelled[loss(-)] - prior * E_toxic[loss(-)])

with the logistic loss; where the second part falls below zero (the model
begins to fit unlabelled toxic texts as clean) its gradient is reversed. The
score is the mean over ``members`` classifiers with seeds of their own.

Training takes bounded samples (``positives``, ``unlabelled``, picked by a hash
of the id); the prior counts all labelled rows. Null and empty texts have no
features and get the score of the intercept; equal texts get equal scores; with
no toxic example every score is 0. Empty tables give empty results; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lathe.llm.common import arrow_batches, blocks, only, texts_of, unit
from lathe.llm.words import MASK, NOT_LETTERS, U, Words, mix

PREFIXES = (4, 5, 6)
#: Kept features, and how much more frequent than in unlabelled texts they are at least.
KEEP, LIFT = 20_000, 2.5
#: Standard deviations by which they are more frequent than by chance.
SURPRISE = 6.0
#: Minimum hashes of a sampled text.
HASHES = 12


@dataclass
class Linear:
    slots: np.ndarray  # sorted feature hashes
    weights: np.ndarray
    intercept: float
    prior: float


def feature_table(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature hash) of every word and beginning, with repeats."""
    words = Words(texts, between=NOT_LETTERS)
    h = words.hashes()
    length = words.end - words.start
    doc = words.doc
    rows, got = [doc], [h]
    for k in PREFIXES:
        at = np.flatnonzero(length > k)
        rows.append(doc[at])
        got.append(mix(words.view[words.start[at]] & MASK[k] ^ U(0xA5A5A5A500000000 + (k << 56))))
    return np.concatenate(rows), np.concatenate(got)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = texts_of(batch)
        for lo, hi in blocks(texts):
            doc, got = feature_table(texts[lo:hi])
            both = np.unique(doc.astype(np.int64) << 31 | (got >> U(33)).astype(np.int64))
            lists = np.split((both & ((1 << 31) - 1)).astype(np.int32), np.searchsorted(both, np.arange(1, hi - lo) << 31))
            low = [[int(mix(x.astype(U) + U(j << 40)).min().view(np.int64)) for j in range(HASHES)] if len(x) else [] for x in lists]
            yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi].cast(pa.int64()), batch.column(batch.schema.get_field_index("toxic"))[lo:hi], pa.array(lists, pa.list_(pa.int32())), pa.array(low, pa.list_(pa.int64()))], names=["id", "toxic", "features", "low"])


def distinct_texts(lows: list[list[int]]) -> list[int]:
    """Numbers of the texts that are no near copies (half of the minimum hashes equal) of one before, so that copies don't pass for evidence."""
    seen: dict[tuple[int, int], list[int]] = {}
    kept = []
    for i, low in enumerate(lows):
        met = [k for j in enumerate(low) for k in seen.get(j, ())]
        if low and (not met or np.bincount(met).max() < HASHES // 2):
            for j in enumerate(low):
                seen.setdefault(j, []).append(len(kept))
            kept.append(i)
    return kept


class Sample:
    """Distinct features of texts, one array for all: text k has ``flat[off[k]:off[k + 1]]``."""

    def __init__(self, rows: pa.Table) -> None:
        rows = rows.sort_by("id").combine_chunks()
        rows = rows.take(pa.array(distinct_texts(rows["low"].to_pylist()), pa.int64()))
        lists = rows["features"].combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) and lists.num_chunks else lists
        self.n = rows.num_rows
        self.flat = lists.flatten().to_numpy() if self.n else np.zeros(0, np.int32)
        self.off = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())]) if self.n else np.zeros(1, np.int64)

    def within(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(text, number of the slot) of the features among ``slots``, a part of the texts at a time."""
        doc, got = [], []
        for a in range(0, self.n, 500):
            b = min(a + 500, self.n)
            f = self.flat[self.off[a] : self.off[b]]
            k = np.minimum(np.searchsorted(slots, f), max(len(slots) - 1, 0))
            hit = np.flatnonzero(slots[k] == f) if len(slots) else np.zeros(0, np.int64)
            got.append(k[hit])
            doc.append(np.searchsorted(self.off, self.off[a] + hit, "right") - 1)
        return np.concatenate(doc or [np.zeros(0, np.int64)]), np.concatenate(got or [np.zeros(0, np.int64)])


def train(positive: Sample, unlabelled: Sample, prior: float, members: int = 3, steps: int = 120, seed: int = 11) -> Linear:
    fp, np_ = np.unique(positive.flat, return_counts=True)
    fp, np_ = fp[np_ >= 3], np_[np_ >= 3]
    in_u = np.bincount(unlabelled.within(fp)[1], minlength=len(fp))
    rate_p, rate_u = np_ / max(positive.n, 1), (in_u + 1) / max(unlabelled.n + 1, 1)
    lift = rate_p / rate_u
    chance = rate_u * positive.n  # toxic texts that would have it if it were as frequent there
    ok = np.flatnonzero((lift >= min(LIFT, 0.5 / prior)) & (np_ - chance >= SURPRISE * np.sqrt(chance)))
    ok = np.sort(ok[np.argsort(-(np_[ok] * np.log(lift[ok])), kind="stable")[:KEEP]])
    slots = fp[ok]

    p, u = (*positive.within(slots), positive.n), (*unlabelled.within(slots), unlabelled.n)
    total, bias = np.zeros(len(slots)), 0.0
    rng = np.random.default_rng(seed)
    for _ in range(members):
        w, b = np.zeros(len(slots)), -1.0
        # each member sees its own weighting of the examples
        wp, wu = rng.exponential(size=p[2]), rng.exponential(size=u[2])
        wp, wu = wp / max(wp.sum(), 1e-12), wu / max(wu.sum(), 1e-12)
        ma, va, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
        for step in range(1, steps + 1):
            zp = b + np.bincount(p[0], w[p[1]], p[2])
            zu = b + np.bincount(u[0], w[u[1]], u[2])
            sp, su = 1 / (1 + np.exp(-np.clip(zp, -40, 40))), 1 / (1 + np.exp(-np.clip(zu, -40, 40)))
            rest = (wu * -np.log1p(-np.minimum(su, 1 - 1e-12))).sum() - prior * (wp * -np.log1p(-np.minimum(sp, 1 - 1e-12))).sum()
            gp, gu = wp * (-prior * sp), wu * su  # of the second part
            if rest < 0:
                gp, gu = -gp, -gu
            gp = gp + prior * wp * (sp - 1)
            gw = np.bincount(p[1], gp[p[0]], len(slots)) + np.bincount(u[1], gu[u[0]], len(slots)) + 1e-4 * w
            gb = gp.sum() + gu.sum()
            ma += 0.1 * (gw - ma)
            va += 0.01 * (gw * gw - va)
            mb += 0.1 * (gb - mb)
            vb += 0.01 * (gb * gb - vb)
            w -= 0.1 * (ma / (1 - 0.9**step)) / (np.sqrt(va / (1 - 0.99**step)) + 1e-6)
            b -= 0.1 * (mb / (1 - 0.9**step)) / (np.sqrt(vb / (1 - 0.99**step)) + 1e-6)
        total += w / members
        bias += b / members
    return Linear(slots, total, float(bias), prior)


def logits(model: Linear, texts: pa.Array) -> np.ndarray:
    doc, got = feature_table(texts)
    got = (got >> U(33)).astype(np.int32)
    if not len(model.slots):
        return np.full(len(texts), model.intercept)
    k = np.minimum(np.searchsorted(model.slots, got), len(model.slots) - 1)
    hit = model.slots[k] == got
    both = np.unique(doc[hit] * np.int64(len(model.slots)) + k[hit])
    return model.intercept + np.bincount(both // len(model.slots), model.weights[both % len(model.slots)], len(texts))


def _score(shared, keep_below: float | None = None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Linear = shared.value
        for batch in batches:
            texts = texts_of(batch)
            if keep_below is not None:
                z = [logits(model, texts[lo:hi]) for lo, hi in blocks(texts)]
                if z:
                    yield batch.filter(pa.array(1 / (1 + np.exp(-np.clip(np.concatenate(z), -40, 40))) < keep_below))
                continue
            for lo, hi in blocks(texts):
                z = logits(model, texts[lo:hi])
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi].cast(pa.int64()), pa.array(1 / (1 + np.exp(-np.clip(z, -40, 40))))], names=["id", "score"])

    return run


def fit(documents: DataFrame, labels: DataFrame, where: Column | None = None, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", positives: int = 2000, unlabelled: int = 5000, **params) -> Linear | None:
    """Train on bounded samples of the rows that ``where`` (on the id) allows; None without a toxic example."""
    docs = only(documents, id=id_col, text=text_col)
    own = only(labels, id=id_col, toxic=label_col)
    if where is not None:
        docs, own = docs.where(where), own.where(where)
    own = own.groupBy("id").agg(F.max("toxic").alias("toxic"))
    n, n_toxic = own.where("toxic is not null").agg(F.count("*"), F.sum("toxic")).first()
    if not n_toxic:
        return None
    prior = float(min(max(n_toxic / n, 0.002), 0.5))
    toxic = own.where((F.col("toxic") == 1) & (unit(F.col("id"), "toxic") < positives / n_toxic)).select("id", "toxic").limit(2 * positives)
    n_docs = docs.count()
    arrow_batches(documents.sparkSession)
    pos = docs.join(F.broadcast(toxic), "id").select("id", "text", F.col("toxic").cast("int").alias("toxic"))  # at most 2 * positives rows
    rest = docs.where(unit(F.col("id"), "unlabelled") < unlabelled / max(n_docs, 1)).limit(2 * unlabelled).select("id", "text", F.lit(0).alias("toxic"))
    positive, rest_ = (Sample(x.mapInArrow(_features, "id long, toxic int, features array<int>, low array<long>").toArrow()) for x in (pos, rest))
    return train(positive, rest_, prior, **params) if positive.n else None


def score(documents: DataFrame, model: Linear | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row."""
    docs = only(documents, id=id_col, text=text_col)
    if model is None:
        return docs.select(F.col("id").alias(id_col), F.lit(0.0).alias("score"))
    arrow_batches(documents.sparkSession)
    return docs.mapInArrow(_score(documents.sparkSession.sparkContext.broadcast(model)), "id long, score double").withColumnRenamed("id", id_col)


def clean(documents: DataFrame, model: Linear | None, threshold: float = 0.5) -> DataFrame:
    """The rows that score below ``threshold``, with all their columns, in one pass over the rows themselves."""
    if model is None:
        return documents
    arrow_batches(documents.sparkSession)
    return documents.mapInArrow(_score(documents.sparkSession.sparkContext.broadcast(model), threshold), documents.schema)
