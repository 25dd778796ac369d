"""Language of texts by a linear-chain conditional random field over their words.

A word is a run of letters (any byte beyond ASCII counts as one). Its features
are affixes of 1 to 4 bytes, byte 3-grams, all hashed, and the languages whose
lexicon lists it. Learned weights of features and of transitions between labels
give, by forward-backward, the probability of each language for each word in
its context. A text's language is the one with the largest mean probability.

Training takes a bounded sample (``docs_per_lang`` documents a language, picked
by a hash of the id) of labelled documents. As such labels don't change inside
a text, training chains are spliced from runs of words of several documents,
so that transitions are learned from switches too; ``splice`` is their share.

Null texts and texts without a letter get ``und`` and score 0. Equal texts get
equal results. With no labelled document every text gets ``und``. Empty tables
give empty results; other columns are not read.
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

#: Hashed features, and words of a chain: longer texts are several chains.
DIM, CHAIN = 1 << 16, 64
AFFIX = (1, 2, 3, 4)


@dataclass
class Crf:
    labels: list[str]
    weights: np.ndarray  # (DIM + labels, labels)
    moves: np.ndarray  # (labels, labels)
    start: np.ndarray  # (labels,)
    lexicon: np.ndarray  # sorted word hashes
    listed: np.ndarray  # (words of the lexicon, labels): share of the word's uses in each language, as float32


def _slot(x: np.ndarray, kind: int) -> np.ndarray:
    return (mix(x ^ U((kind * 0x9E3779B97F4A7C15) & (2**64 - 1))) >> U(48)).astype(np.int64)


def features(words: Words, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature slots of the words numbered ``at``, and where each word's slots begin."""
    start, end = words.start[at], words.end[at]
    length = end - start
    grams = np.maximum(length - 2, 0)
    width = 2 * len(AFFIX) + grams
    off = np.concatenate([[0], np.cumsum(width)])
    out = np.empty(off[-1], np.int64)
    for j, k in enumerate(AFFIX):
        n = np.minimum(length, k)
        out[off[:-1] + 2 * j] = _slot(words.view[start] & MASK[n], k)
        out[off[:-1] + 2 * j + 1] = _slot(words.view[end - n] & MASK[n], 8 + k)
    word = np.repeat(np.arange(len(at)), grams)
    inner = np.arange(len(word)) - np.repeat(np.cumsum(grams) - grams, grams)
    out[off[word] + 2 * len(AFFIX) + inner] = _slot(words.view[start[word] + inner] & MASK[3], 16)
    return out, off


def _listed(model: Crf, h: np.ndarray) -> np.ndarray:
    if not len(model.lexicon):
        return np.zeros((len(h), len(model.labels)))
    k = np.minimum(np.searchsorted(model.lexicon, h), len(model.lexicon) - 1)
    return np.where((model.lexicon[k] == h)[:, None], model.listed[k], 0.0)


def emissions(model: Crf, words: Words, at: np.ndarray, h: np.ndarray) -> np.ndarray:
    slots, off = features(words, at)
    n = len(model.labels)
    got = np.empty((len(at), n))
    for j in range(n):
        got[:, j] = np.add.reduceat(model.weights[:DIM, j][slots], off[:-1]) if len(at) else 0
    return got + _listed(model, h) @ model.weights[DIM:]


def forward_backward(score: np.ndarray, lens: np.ndarray, moves: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """``score`` (words, chains, labels), chains by falling length -> label probabilities, expected moves, log-likelihood's norm."""
    steps, _, n = score.shape
    live = [int(np.searchsorted(-lens, -t, "left")) for t in range(steps)]  # chains with more than t words
    top = score.max(axis=2, keepdims=True)
    e = np.exp(score - top)
    m = np.exp(moves)
    f = np.zeros_like(e)
    scale = np.ones(e.shape[:2])
    first = np.exp(start) * e[0]
    scale[0] = first.sum(axis=1)
    f[0] = first / scale[0][:, None]
    for t in range(1, steps):
        k = live[t]
        x = (f[t - 1, :k] @ m) * e[t, :k]
        s = x.sum(axis=1)
        scale[t, :k] = s
        f[t, :k] = x / s[:, None]
    b = np.ones_like(e)
    pairs = np.zeros((n, n))
    for t in range(steps - 2, -1, -1):
        k = live[t + 1]
        x = e[t + 1, :k] * b[t + 1, :k] / scale[t + 1, :k, None]
        pairs += m * (f[t, :k].T @ x)
        b[t, :k] = x @ m.T
    mask = np.arange(steps)[:, None] < lens[None, :]
    norm = float(np.log(scale[mask]).sum() + top[:, :, 0][mask].sum())
    return f * b, pairs, norm


def train(texts: list[str], langs: list[str], seed: int = 7, chains: int = 4000, length: int = 32, splice: float = 0.5, steps: int = 40) -> Crf:
    """Maximum likelihood (with a small square penalty) by Adam on spliced chains."""
    labels = sorted(set(langs))
    n = len(labels)
    words = Words(pa.array(texts, pa.large_string()), between=NOT_LETTERS)
    h = words.hashes()
    of = np.array([labels.index(x) for x in langs])
    types, first, kind = np.unique(h, return_index=True, return_inverse=True)
    # the lexicon: words of two documents or more, with the smoothed share of each language in their documents
    seen = np.unique(np.stack([kind, words.doc]), axis=1)
    uses = np.zeros((len(types), n))
    np.add.at(uses, (seen[0], of[seen[1]]), 1)
    per = np.maximum(np.bincount(of, minlength=n), 1)
    rate = uses / per
    common = uses.sum(axis=1) >= 2
    listed = (rate / np.maximum(rate.sum(axis=1, keepdims=True), 1e-12)).astype(np.float32)
    model = Crf(labels, np.zeros((DIM + n, n)), np.zeros((n, n)), np.zeros(n), types[common], listed[common])
    if n < 2 or not len(h):
        return model
    rng = np.random.default_rng(seed)
    full = np.flatnonzero(words.count >= 4)
    by_lang = [full[of[full] == j] for j in range(n)]
    there = [j for j in range(n) if len(by_lang[j])]
    if len(there) < 2:
        return model
    at = np.empty((length, chains), np.int64)
    gold = np.empty((length, chains), np.int64)
    for c in range(chains):
        cuts = sorted(rng.choice(np.arange(4, length - 3), rng.integers(1, 3), replace=False)) if rng.random() < splice else []
        for a, b in zip([0, *cuts], [*cuts, length], strict=True):
            lang = there[rng.integers(len(there))]
            doc = by_lang[lang][rng.integers(len(by_lang[lang]))]
            lo, size = words.off[doc], words.off[doc + 1] - words.off[doc]
            at[a:b, c] = lo + (rng.integers(size) + np.arange(b - a)) % size
            gold[a:b, c] = lang
    used, place = np.unique(kind[at], return_inverse=True)
    place = place.reshape(at.shape)
    slots, off = features(words, first[used])
    owner = np.repeat(np.arange(len(used)), np.diff(off))
    # a lexicon that lists every training word would leave affixes nothing to explain: hide it in part of the words
    known = _listed(model, types[used]) * (rng.random(len(used)) < 0.5)[:, None]
    truth = np.zeros((len(used), n))
    np.add.at(truth, (place.ravel(), gold.ravel()), 1)
    moved = np.zeros((n, n))
    np.add.at(moved, (gold[:-1].ravel(), gold[1:].ravel()), 1)
    begun = np.bincount(gold[0], minlength=n).astype(float)
    lens = np.full(chains, length)
    params = [model.weights, model.moves, model.start]
    first_m, second_m = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        word = np.stack([np.bincount(owner, model.weights[:DIM, j][slots], len(used)) for j in range(n)], axis=1) + known @ model.weights[DIM:]
        p, pairs, _ = forward_backward(word[place], lens, model.moves, model.start)
        miss = truth.copy()
        for j in range(n):
            miss[:, j] -= np.bincount(place.ravel(), p[:, :, j].ravel(), len(used))
        grads = [np.concatenate([np.stack([np.bincount(slots, miss[owner, j], DIM) for j in range(n)], axis=1), known.T @ miss]), moved - pairs, begun - p[0].sum(axis=0)]
        for x, g, a, b in zip(params, grads, first_m, second_m, strict=True):
            g = g / chains - 1e-4 * x
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            x += 0.1 * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
    return model


def label_words(model: Crf, words: Words) -> np.ndarray:
    """Probability of each label for each word of a block of texts."""
    h = words.hashes()
    types, first, kind = np.unique(h, return_index=True, return_inverse=True)
    word = emissions(model, words, first, types)
    count = words.count
    chains = -(-count // CHAIN)
    doc = np.repeat(np.arange(len(count)), chains)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(chains) - chains, chains)
    begin = words.off[doc] + nth * CHAIN
    lens = np.minimum(words.off[doc + 1] - begin, CHAIN)
    order = np.argsort(-lens, kind="stable")
    begin, lens = begin[order], lens[order]
    out = np.empty((len(h), len(model.labels)))
    for lo in range(0, len(lens), 4096):
        b, size = begin[lo : lo + 4096], lens[lo : lo + 4096]
        steps = np.arange(size[0])[:, None]
        real = steps < size[None, :]
        at = np.where(real, b[None, :] + steps, b[None, :])
        p, _, _ = forward_backward(word[kind[at]], size, model.moves, model.start)
        out[at[real]] = p[real]
    return out


def _predict(shared, spans: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Crf = shared.value
        for batch in batches:
            texts, ids = texts_of(batch), batch.column(0)
            letters = batch.column(batch.schema.get_field_index("letters")).to_numpy(zero_copy_only=False).astype(bool)
            for lo, hi in blocks(texts):
                words = Words(texts[lo:hi], between=NOT_LETTERS)
                p = label_words(model, words) if len(words.start) else np.zeros((0, len(model.labels)))
                if spans:
                    yield _spans(model, words, p, ids[lo:hi])
                    continue
                total = np.concatenate([np.zeros((1, len(model.labels))), np.cumsum(p, axis=0)])
                mean = (total[words.off[1:]] - total[words.off[:-1]]) / np.maximum(words.count, 1)[:, None]
                best = mean.argmax(axis=1)
                known = letters[lo:hi] & (words.count > 0)
                lang = [model.labels[j] if ok else "und" for j, ok in zip(best, known, strict=True)]
                score = np.where(known, np.clip(mean[np.arange(len(best)), best], 0, 1), 0.0)
                yield pa.RecordBatch.from_arrays([ids[lo:hi].cast(pa.int64()), pa.array(lang, pa.string()), pa.array(score), pa.array(words.count.astype(np.int64))], names=["id", "lang_pred", "score", "n_letter_words"])

    return run


def _spans(model: Crf, words: Words, p: np.ndarray, ids: pa.Array) -> pa.RecordBatch:
    best, doc = p.argmax(axis=1), words.doc
    new = np.ones(len(best), bool)
    new[1:] = (best[1:] != best[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    end = np.append(at[1:], len(best))
    base = words.off[doc[at]]
    total = np.concatenate([[0.0], np.cumsum(p[np.arange(len(best)), best])])
    return pa.RecordBatch.from_arrays([
        pa.array(ids.cast(pa.int64()).to_numpy(zero_copy_only=False)[doc[at]]), pa.array([model.labels[j] for j in best[at]], pa.string()),
        pa.array((at - base).astype(np.int64)), pa.array((end - base).astype(np.int64)), pa.array((total[end] - total[at]) / (end - at))], names=["id", "lang", "word_from", "word_to", "score"])


def fit(documents: DataFrame, where: Column | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", docs_per_lang: int = 300, **params) -> Crf | None:
    """Train on at most about ``docs_per_lang`` documents a language, picked by a hash of the id; None without any."""
    docs = only(documents if where is None else documents.where(where), id=id_col, text=text_col, lang=lang_col).where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = {r.lang: r["count"] for r in docs.groupBy("lang").count().collect()}
    if not counts:
        return None
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, min(1.0, docs_per_lang / n)).otherwise(share)
    rows = docs.where(unit(F.col("id"), "langid") < share).toPandas().sort_values("id")
    rows = rows.groupby("lang").head(2 * docs_per_lang)
    return train(rows["text"].tolist(), rows["lang"].tolist(), **params) if len(rows) else None


def predict(documents: DataFrame, model: Crf | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, n_letter_words) of every row."""
    docs = only(documents, id=id_col, text=text_col).withColumn("letters", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    if model is None:
        return docs.select(F.col("id").alias(id_col), F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("n_letter_words"))
    arrow_batches(documents.sparkSession)
    got = docs.mapInArrow(_predict(documents.sparkSession.sparkContext.broadcast(model), False), "id long, lang_pred string, score double, n_letter_words long")
    return got.withColumnRenamed("id", id_col)


def language_spans(documents: DataFrame, model: Crf, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang, word_from, word_to, score): runs of words with the same most likely label, code-switched parts apart."""
    docs = only(documents, id=id_col, text=text_col).withColumn("letters", F.lit(True))
    arrow_batches(documents.sparkSession)
    got = docs.mapInArrow(_predict(documents.sparkSession.sparkContext.broadcast(model), True), "id long, lang string, word_from long, word_to long, score double")
    return got.withColumnRenamed("id", id_col)
