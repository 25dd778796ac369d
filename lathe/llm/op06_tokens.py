"""Token counts of byte-level BPE by rank-synchronous merging of ragged arrays.

New pieces of text are cut into pre-tokens, held side by side as one array of
symbols. In each round the pairs of neighbours get their merge ranks, every
pre-token finds its lowest one, and all its places with that pair are merged at
once, in all pre-tokens together. When no pair has a rank, what is left is
counted. Merging all places at once equals one at a time from the left, as a
merge makes only pairs of higher rank.

Counts are kept per distinct piece in each worker (a bounded dictionary). Null
and empty texts have 0 tokens; equal texts equal counts; special strings inside
a text count as one token each, the library's default. Empty tables give
empty results; other columns are not read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathe.llm.common import arrow_batches, blocks, only, texts_of
from lathe.llm.pretokens import Pieces

#: The pattern of the vocabulary's ByteLevel pre-tokenizer (a fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NONE = np.iinfo(np.int32).max


def _byte_letters() -> list[str]:
    """The character that stands for each byte in the vocabulary file: itself if printable, else the next from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b if b in shown else next(hidden)) for b in range(256)]


class Merges:
    """Symbols of bytes, and rank and outcome of every pair that merges, as sorted arrays."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.size = max(vocab.values()) + 1
        self.byte = np.array([vocab[c] for c in _byte_letters()], np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        key = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(key)
        self.key, self.rank = key[order], order.astype(np.int32)
        self.out = np.array([vocab[a + b] for a, b in pairs], np.int32)[order]
        self.special = [t["content"] for t in spec["added_tokens"]]

    def ranks(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = a.astype(np.int64) * self.size + b
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        hit = self.key[at] == key
        return np.where(hit, self.rank[at], NONE), self.out[at]


def count_symbols(merges: Merges, words: list[bytes]) -> np.ndarray:
    """Symbols left of each pre-token after all merges."""
    done = np.zeros(len(words), np.int64)
    lens = np.fromiter(map(len, words), np.int64, len(words))
    sym = merges.byte[np.frombuffer(b"".join(words), np.uint8)]
    seq = np.repeat(np.arange(len(words)), lens)
    while len(sym) > 1:
        rank, out = merges.ranks(sym[:-1], sym[1:])
        rank = np.where(seq[1:] == seq[:-1], rank, NONE)
        first = np.flatnonzero(np.append(True, seq[1:] != seq[:-1]))
        low = np.minimum.reduceat(np.append(rank, NONE), first)
        ended = low == NONE
        size = np.diff(np.append(first, len(sym)))
        done[seq[first[ended]]] = size[ended]
        place = np.repeat(low, size)[:-1]
        at = np.flatnonzero((rank == place) & (rank != NONE))
        # of overlapping places take every second one, from the left
        run = np.append(True, np.diff(at) != 1) if len(at) else np.zeros(0, bool)
        nth = np.arange(len(at)) - np.maximum.accumulate(np.where(run, np.arange(len(at)), 0)) if len(at) else at
        at = at[nth % 2 == 0]
        keep = ~np.repeat(ended, size)
        sym[at] = out[at]
        keep[at + 1] = False
        sym, seq = sym[keep], seq[keep]
    if len(sym):
        done[seq] = 1
    return done


@lru_cache(2)
def counter(path: str) -> Pieces:
    """One for each worker process: later partitions find its pieces counted."""
    merges = Merges(path)
    special = merges.special[0] if merges.special else None
    whole = Pieces(None, PATTERN, special)

    def compute(strings: list[str]) -> list[int]:
        owner, words, extra = [], [], np.zeros(len(strings), np.int64)
        for k, s in enumerate(strings):
            if special and special in s:
                extra[k] = s.count(special)
                parts = [w for x in s.split(special) for w in whole.pattern.findall(x)]
            else:
                parts = whole.pattern.findall(s)
            owner += [k] * len(parts)
            words += parts
        # equal pre-tokens of different pieces are merged once
        distinct = {w: i for i, w in enumerate(dict.fromkeys(words))}
        left = count_symbols(merges, [w.encode() for w in distinct]) if distinct else np.zeros(0, np.int64)
        at = np.fromiter((distinct[w] for w in words), np.int64, len(words))
        return (np.bincount(np.array(owner, np.int64), left[at], len(strings)).astype(np.int64) + extra).tolist() if words else extra.tolist()

    return Pieces(compute, PATTERN, special)


def _count(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = counter(path)
        for batch in batches:
            texts, ids = texts_of(batch), batch.column(0).cast(pa.int64())
            for lo, hi in blocks(texts):
                part = texts[lo:hi]
                n = [sum(x) for x in known.of(part.to_pylist())]
                size = np.diff(np.frombuffer(part.buffers()[1], np.int64)[part.offset : part.offset + len(part) + 1])
                yield pa.RecordBatch.from_arrays([ids[lo:hi], pa.array(size), pa.array(n, pa.int64())], names=["id", "n_bytes", "n_tokens"])

    return run


def count_tokens(documents: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row; ``vocabulary``: path of the file, the same on all executors."""
    arrow_batches(documents.sparkSession)
    got = only(documents, id=id_col, text=text_col).mapInArrow(_count(vocabulary), "id long, n_bytes long, n_tokens long")
    return got.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
