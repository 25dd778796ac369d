"""Byte-level BPE by corpus-level merge replay, and its decoding.

The distinct words of a block of texts (matches of the vocabulary's pattern)
lie side by side as one array of symbols with links to both neighbours. An
inverted index holds, for every rank, the positions whose pair has it. The
ranks are replayed from the lowest on: one merge is applied at all its
positions in every word at once, from the left, and only the pairs with the
two touched neighbours enter the index anew. The work is that of the merges
made, whatever a word's length: a text without spaces is one long word. Ids
of a text are those of its words.

A pair's rank is that of the bytes it makes, as in the rank files' library. A
vocabulary may hold a token whose bytes also arise from two parts of higher
rank; where a merge makes such a pair, its rank is already past, and merging
other positions first could differ. Those words are encoded alone, one merge
at a time, always the lowest rank (of equal ones the leftmost).

Spark deals the texts; each Python worker keeps the words that it has met,
bounded by bytes, and longer words not at all. Null and empty texts have no
ids (digest of the empty string); equal texts have equal results; a byte that
the vocabulary lacks is an error when it is loaded. Only the id and text
columns are read, so clashing names don't matter; null ids are kept as they
are; empty tables give empty results.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathe.llm.common import arrow_batches, blocks, only, texts_of
from lathe.llm.pretokens import Pieces

#: Bytes of text whose new words are replayed together.
BLOCK_BYTES = 4 << 20


class Vocabulary:
    """Tokens by id, the id of each byte, and the rank (= id) that each pair of tokens makes."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, f))}
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.size = max(ranks.values()) + 1
        self.id = ranks
        self.token = [b""] * self.size
        self.pair: dict[int, int] = {}
        for whole, rank in ranks.items():
            self.token[rank] = whole
            for k in range(1, len(whole)):
                a, b = ranks.get(whole[:k]), ranks.get(whole[k:])
                if a is not None and b is not None:
                    self.pair[a * self.size + b] = rank
        self.key = np.fromiter(sorted(self.pair), np.int64, len(self.pair))
        self.rank = np.array([self.pair[k] for k in self.key.tolist()], np.int64)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 for none."""
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, self.rank[at], -1)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


def encode_alone(vocabulary: Vocabulary, word: bytes) -> list[int]:
    """One word, one merge at a time: the lowest rank, of equal ones the leftmost."""
    if word in vocabulary.id:
        return [vocabulary.id[word]]
    n, size, pair = len(word), vocabulary.size, vocabulary.pair
    sym = vocabulary.byte[np.frombuffer(word, np.uint8)].tolist()
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(pair[sym[i] * size + sym[i + 1]], i, sym[i], sym[i + 1]) for i in range(n - 1) if sym[i] * size + sym[i + 1] in pair]
    heapq.heapify(heap)
    while heap:
        rank, i, a, b = heapq.heappop(heap)
        j = after[i]
        if sym[i] != a or j >= n or sym[j] != b:
            continue
        sym[i], sym[j] = rank, -1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if (got := pair.get(rank * size + sym[k])) is not None:
                heapq.heappush(heap, (got, i, rank, sym[k]))
        h = before[i]
        if h >= 0 and (got := pair.get(sym[h] * size + rank)) is not None:
            heapq.heappush(heap, (got, h, sym[h], rank))
    return [s for s in sym if s >= 0]


def replay(vocabulary: Vocabulary, words: list[bytes]) -> list[list[int]]:
    """Ids of every word, by replaying the merges over all of them in rank order."""
    if not words:
        return []
    raw = np.frombuffer(b"".join(words), np.uint8)
    lens = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lens)
    n = len(raw)
    sym = vocabulary.byte[raw].astype(np.int64)
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    full = lens > 0
    after[ends[full] - 1] = n  # n and -1: no neighbour
    before[(ends - lens)[full]] = -1
    index: dict[int, list[np.ndarray]] = {}
    todo: list[int] = []

    def enter(ranks: np.ndarray, at: np.ndarray) -> None:
        order = np.argsort(ranks, kind="stable")
        ranks, at = ranks[order], at[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        for r, part in zip(ranks[np.append(0, cuts)].tolist(), np.split(at, cuts), strict=True):
            if r in index:
                index[r].append(part)
            else:
                index[r] = [part]
                heapq.heappush(todo, r)

    at = np.flatnonzero(after < n)
    rank = vocabulary.ranks(sym[at], sym[after[at]])
    if (rank >= 0).any():
        enter(rank[rank >= 0], at[rank >= 0])
    odd: list[int] = []  # positions in words that are encoded alone
    while todo:
        now = heapq.heappop(todo)
        parts = index.pop(now)
        i = np.unique(np.concatenate(parts))  # two merges may have named the pair between them
        i = i[(sym[i] >= 0) & (after[i] < n)]
        j = after[i]
        still = vocabulary.ranks(sym[i], sym[j]) == now  # else a neighbour has merged since
        i, j = i[still], j[still]
        if len(i) > 1 and (j[:-1] == i[1:]).any():
            # of overlapping pairs every second one, from the left
            new = np.append(True, j[:-1] != i[1:])
            nth = np.arange(len(i)) - np.flatnonzero(new)[np.cumsum(new) - 1]
            i, j = i[nth % 2 == 0], j[nth % 2 == 0]
        if not len(i):
            continue
        sym[i], sym[j] = now, -1
        k = after[j]
        after[i] = k
        inner = k < n
        before[k[inner]] = i[inner]
        # the pairs with both touched neighbours
        h = before[i]
        left, right = i[h >= 0], i[inner]
        place = np.concatenate([h[h >= 0], right])
        rank = vocabulary.ranks(sym[place], np.concatenate([sym[left], sym[k[inner]]]))
        late = (rank >= 0) & (rank <= now)
        if late.any():
            odd += place[late].tolist()
        fresh = rank > now
        if fresh.any():
            enter(rank[fresh], place[fresh])
    alive = np.flatnonzero(sym >= 0)
    bounds = np.searchsorted(alive, ends).tolist()
    ids = sym[alive].tolist()
    out = [ids[a:b] for a, b in zip([0, *bounds[:-1]], bounds, strict=True)]
    for w in set(np.searchsorted(ends, odd, "right").tolist()):
        out[w] = encode_alone(vocabulary, words[w])
    # the library takes a word that is a token as it is; merges lead there too where a vocabulary was trained by them
    for w, got in enumerate(out):
        if len(got) > 1 and (whole := vocabulary.id.get(words[w])) is not None:
            out[w] = [whole]
    return out


@lru_cache(2)
def encoder(path: str, pattern: str) -> Pieces:
    """Of each piece: number of ids, the ids in decimal joined by commas, the bytes they decode to. One for each worker."""
    vocabulary = Vocabulary(path)
    whole = Pieces(None, pattern).pattern
    decimal, token = [str(k) for k in range(vocabulary.size)].__getitem__, vocabulary.token.__getitem__

    def compute(strings: list[str]) -> list[tuple[int, str, bytes]]:
        cut = [whole.findall(s) for s in strings]
        place = {w: k for k, w in enumerate(dict.fromkeys(w for words in cut for w in words))}
        ids = replay(vocabulary, [w.encode() for w in place])
        out = []
        for words in cut:
            got = ids[place[words[0]]] if len(words) == 1 else [x for w in words for x in ids[place[w]]]
            out.append((len(got), ",".join(map(decimal, got)), b"".join(map(token, got))))
        return out

    return Pieces(compute, pattern)


def _digests(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(path, pattern)
        for batch in batches:
            texts, ids = texts_of(batch), batch.column(0)
            for lo, hi in blocks(texts, BLOCK_BYTES):
                n, digest, back = [], [], []
                for parts in known.of(texts[lo:hi].to_pylist()):
                    n.append(sum(p[0] for p in parts))
                    digest.append(hashlib.sha256(",".join([p[1] for p in parts if p[0]]).encode()).hexdigest())
                    back.append(hashlib.sha256(b"".join([p[2] for p in parts])).hexdigest())
                yield pa.RecordBatch.from_arrays([ids[lo:hi], pa.array(n, pa.int64()), pa.array(digest), pa.array(back)], names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def _encoded(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(path, pattern)
        for batch in batches:
            texts, ids = texts_of(batch), batch.column(0)
            for lo, hi in blocks(texts, BLOCK_BYTES):
                got = [[int(x) for p in parts if p[0] for x in p[1].split(",")] for parts in known.of(texts[lo:hi].to_pylist())]
                yield pa.RecordBatch.from_arrays([ids[lo:hi], pa.array(got, pa.list_(pa.int32()))], names=["id", "ids"])

    return run


@lru_cache(2)
def _vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _decoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(path)
        for batch in batches:
            got = [None if ids is None else vocabulary.decode(ids) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.binary())], names=["id", "bytes"])

    return run


def _id_type(df: DataFrame, id_col: str) -> str:
    return df.select(F.col(f"`{id_col}`")).schema[0].dataType.simpleString()


def encode(documents: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids) of every row: the whole text's token ids."""
    arrow_batches(documents.sparkSession)
    got = only(documents, id=id_col, text=text_col).mapInArrow(_encoded(vocabulary, pattern), f"id {_id_type(documents, id_col)}, ids array<int>")
    return got.withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, bytes) of every row of ids; null ids give null."""
    arrow_batches(encoded.sparkSession)
    got = only(encoded, id=id_col, ids=ids_col).mapInArrow(_decoded(vocabulary), f"id {_id_type(encoded, id_col)}, bytes binary")
    return got.withColumnRenamed("id", id_col)


def digests(documents: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every row, encoded and decoded again in one pass."""
    arrow_batches(documents.sparkSession)
    schema = f"id {_id_type(documents, id_col)}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return only(documents, id=id_col, text=text_col).mapInArrow(_digests(vocabulary, pattern), schema).withColumnRenamed("id", id_col)
