"""Token ids as fixed-stride shards in training order.

Texts are encoded, end with ``eos`` and run on one after another, some
megabytes of them at a time; this stream is cut into sequences of ``length``
ids, so that a text's end costs no filling (only a stream's last sequence is
filled up with ``eos``; its record says how many ids are real). The one pass
over the texts writes packed ids to the shared folder, each row with the
number of sequences that its task wrote before it. With the tasks' totals (one
number a task) every sequence has its number. A keyed Feistel
permutation of the next power of four, walked until it lands below the number
of sequences, turns it into a slot: a bijection, with no sort and no table.

Slots ``[k * per_shard, (k + 1) * per_shard)`` make shard k. Each task gathers its
sequences by shard, so few and large rows are shuffled; each shard is one buffer
of fixed size, filled by position, written as a file of records of equal stride
(``RECORD`` header, then ids). The header names the text that a sequence begins
in and how many of its ids stand in earlier sequences; after its records a
shard lists the texts that begin inside them (``START``). Slot s is at byte ``(s % per_shard) * stride`` of shard
``s // per_shard``: a reader goes on from any slot after a restart.

Null and empty texts are ``eos`` alone; null ids are -1. Repeated rows stand in
the stream as often. A very long text is a stream of its own, in memory as a
whole. An empty table gives no shard. Other columns are not read.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathe.llm.common import BATCH_BYTES, arrow_batches, blocks, cut, only, scratch, texts_of
from lathe.llm.files import attempt_name, opened
from lathe.llm.op06_tokens import PATTERN
from lathe.llm.words import U, mix

#: What stands before the ids of a record: the text it begins in, that text's ids before it, the ids that are real.
RECORD = np.dtype([("id", "<i8"), ("offset", "<i4"), ("n", "<i4")])
#: A text that begins inside a sequence: the sequence's place in the shard, the id's place in the sequence, the text.
START = np.dtype([("place", "<i4"), ("offset", "<i4"), ("id", "<i8")])
ROUNDS = 4
#: Bytes of records that a task gathers before they are dealt to shards, and the level of packing.
GATHERED, LEVEL = 24 << 20, 6


class Slots:
    """The keyed permutation of ``range(n)``."""

    def __init__(self, n: int, key: int) -> None:
        self.n = n
        self.half = U(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
        self.keys = [mix(np.array([key * ROUNDS + r], np.int64).view(U))[0] for r in range(ROUNDS)]

    def _once(self, x: np.ndarray) -> np.ndarray:
        low = (U(1) << self.half) - U(1)
        a, b = x >> self.half, x & low
        for k in self.keys:
            a, b = b, a ^ (mix(b ^ k) & low)
        return a << self.half | b

    def of(self, index: np.ndarray) -> np.ndarray:
        x = self._once(index.astype(U))
        out = np.flatnonzero(x >= U(self.n))
        while len(out):
            x[out] = self._once(x[out])
            out = out[x[out] >= U(self.n)]
        return x.astype(np.int64)


@lru_cache(2)
def encoding(path: str):
    """One for each worker process."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    if len(ranks) >= 1 << 16:
        raise ValueError("ids of this vocabulary don't fit 16 bits")
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _encoded(path: str, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, before, part = encoding(path).encode_ordinary, 0, TaskContext.get().partitionId()
        pack = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            texts, ids = texts_of(batch), batch.column(0).to_numpy(zero_copy_only=False)
            for lo, hi in blocks(texts, BATCH_BYTES):
                tokens = [np.array(encode(t), "<u2") for t in texts[lo:hi].to_pylist()]
                size = np.array([len(t) for t in tokens], "<i4")
                n = -(-(int(size.sum()) + len(size)) // length)
                head = pack.compress(ids[lo:hi].astype("<i8").tobytes() + size.tobytes())
                blob = pack.compress(b"".join(t.tobytes() for t in tokens))
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([before], pa.int64()), pa.array([n], pa.int64()), pa.array([hi - lo], pa.int64()), pa.array([head], pa.binary()), pa.array([blob], pa.binary())], names=["part", "before", "n", "texts", "head", "blob"])
                before += n

    return run


def _stream(head: bytes, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, sizes and places of a packed row's texts in its stream; each is followed by ``eos``."""
    ids, size = np.frombuffer(head, "<i8", texts), np.frombuffer(head, "<i4", texts, 8 * texts).astype(np.int64)
    return ids, size, np.cumsum(size + 1) - size - 1


def _records(head: bytes, blob: bytes, texts: int, length: int, eos: int) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a packed row's records, one line each, and the texts that begin inside them by record."""
    ids, size, first = _stream(head, texts)
    tokens = np.frombuffer(blob, "<u2")
    total = int(size.sum()) + texts
    out = np.full((-(-total // length), length), eos, "<u2")
    out.reshape(-1)[np.arange(len(tokens)) + np.repeat(np.arange(texts), size)] = tokens
    begin = np.arange(len(out)) * length
    text = np.searchsorted(first, begin, "right") - 1
    records = np.empty(len(out), RECORD)
    records["id"], records["offset"], records["n"] = ids[text], begin - first[text], np.minimum(total - begin, length)
    inside = np.flatnonzero(first % length)
    starts = np.empty(len(inside), START)
    starts["place"], starts["offset"], starts["id"] = first[inside] // length, first[inside] % length, ids[inside]
    return np.concatenate([records.view(np.uint8).reshape(-1, RECORD.itemsize), out.view(np.uint8)], axis=1), starts


def _dealt(eos: int, length: int, per_shard: int, key: int, n: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots, pack, unpack = Slots(n, key), zstandard.ZstdCompressor(level=LEVEL), zstandard.ZstdDecompressor()
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []

        def by_shard() -> pa.RecordBatch:
            slot, records, start_slot, starts = (np.concatenate([h[k] for h in held]) for k in range(4))
            order, start_order = np.argsort(slot, kind="stable"), np.argsort(start_slot, kind="stable")
            shard, start_shard = slot[order] // per_shard, start_slot[start_order] // per_shard
            starts["place"] = start_slot % per_shard
            cuts = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
            rows = []
            for a, b in zip(cuts, [*cuts[1:], len(order)], strict=True):
                lo, hi = np.searchsorted(start_shard, [shard[a], shard[a] + 1])
                blob = (slot[order[a:b]] % per_shard).astype("<i4").tobytes() + records[order[a:b]].tobytes() + starts[start_order[lo:hi]].tobytes()
                rows.append((int(shard[a]), int(b - a), pack.compress(blob)))
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["shard", "n", "blob"])

        for batch in batches:
            for part, before, k, texts, head, blob in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                begin = shared.value[part] + before
                slot = slots.of(np.arange(begin, begin + k))
                records, starts = _records(unpack.decompress(head), unpack.decompress(blob), texts, length, eos)
                held.append((slot, records, slot[starts["place"]], starts))
                if sum(h[1].nbytes for h in held) >= GATHERED:
                    yield by_shard()
                    held.clear()
        if held:
            yield by_shard()

    return run


def _written(folder: str, row: int, per_shard: int, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = opened(folder)
        shard, buffer, filled = None, None, 0
        starts: list[bytes] = []
        unpack = zstandard.ZstdDecompressor()

        def ended() -> pa.RecordBatch:
            size = min(per_shard, n - shard * per_shard)
            if filled != size:
                raise RuntimeError(f"shard {shard} has {filled} of {size} sequences")
            path = f"{base}/{attempt_name(f'shard-{shard:08d}.bin')}"
            texts = np.frombuffer(b"".join(starts), START)
            data = buffer[: size * row].tobytes() + texts[np.lexsort((texts["offset"], texts["place"]))].tobytes()
            starts.clear()
            with store.open_output_stream(path) as f:
                f.write(data)
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([path]), pa.array([size], pa.int64()), pa.array([zlib.crc32(data)], pa.int64())], names=["shard", "path", "n", "crc32"])

        for batch in batches:
            for s, k, blob in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if s != shard:
                    if shard is not None:
                        yield ended()
                    shard, filled = s, 0
                    buffer = np.zeros(min(per_shard, n - s * per_shard) * row, np.uint8)
                data = unpack.decompress(blob)
                buffer.reshape(-1, row)[np.frombuffer(data, "<i4", k)] = np.frombuffer(data, np.uint8, k * row, 4 * k).reshape(k, row)
                starts.append(data[k * (4 + row) :])
                filled += k
        if shard is not None:
            yield ended()

    return run


def write_shards(documents: DataFrame, vocabulary: str, folder: str | None = None, key: int = 20_240, length: int = 256, per_shard: int = 32_768, eos: int = 50_256, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, dict]:
    """The manifest (shard, path, n, crc32), a table in the shared folder, and the layout that readers need."""
    spark = documents.sparkSession
    docs = only(documents, id=id_col, text=text_col).withColumn("id", F.coalesce(F.col("id").cast("long"), F.lit(-1)))
    arrow_batches(spark)
    packed = cut(docs.mapInArrow(_encoded(vocabulary, length), "part int, before long, n long, texts long, head binary, blob binary"))
    offsets, n = {}, 0
    for p in sorted(packed.groupBy("part").agg(F.sum("n").alias("n")).collect()):  # a number for each task
        offsets[p.part] = n
        n += p.n
    folder = folder or scratch(spark)
    store, base = opened(folder)
    store.create_dir(base, recursive=True)
    row = RECORD.itemsize + 2 * length
    run = _dealt(eos, length, per_shard, key, n, spark.sparkContext.broadcast(offsets))
    shards = -(-n // per_shard)
    dealt = packed.mapInArrow(run, "shard long, n long, blob binary").repartitionById(max(1, min(shards, 100_000)), F.pmod("shard", F.lit(max(1, min(shards, 100_000)))).cast("int")).sortWithinPartitions("shard")
    manifest = cut(dealt.mapInArrow(_written(folder, row, per_shard, n), "shard long, path string, n long, crc32 long"))
    return manifest, {"folder": folder, "length": length, "stride": row, "per_shard": per_shard, "sequences": n, "key": key, "eos": eos}


def _read(folder: str, layout: dict, from_slot: int, ids: bool):
    row, per_shard, length = layout["stride"], layout["per_shard"], layout["length"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = opened(folder)
        names = ["slot", "doc_id", "doc_offset", "n_tokens", "shard", "byte_offset", "tokens_crc32"] + ["tokens"] * ids
        for batch in batches:
            for shard, path, n in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                at = max(0, from_slot - shard * per_shard)
                with store.open_input_file(path) as f:
                    f.seek(n * row)
                    starts = np.frombuffer(f.read(), START)
                    f.seek(at * row)
                    while at < n:
                        k = min(4096, n - at)
                        data = np.frombuffer(f.read(k * row), np.uint8).reshape(k, row)
                        head = data[:, : RECORD.itemsize].copy().view(RECORD)[:, 0]
                        tokens = np.ascontiguousarray(data[:, RECORD.itemsize :]).view("<u2").reshape(-1)
                        lo, hi = np.searchsorted(starts["place"], [at, at + k])
                        # a piece of text from each sequence's begin and from each start inside it
                        place = np.concatenate([np.arange(k), starts["place"][lo:hi] - at])
                        begin = np.concatenate([np.zeros(k, np.int64), starts["offset"][lo:hi]])
                        order = np.lexsort((begin, place))
                        place, begin = place[order], begin[order]
                        end = np.append(begin[1:], 0)
                        last = np.append(place[1:] != place[:-1], True)
                        end[last] = head["n"]
                        doc = np.concatenate([head["id"], starts["id"][lo:hi]])[order]
                        before = np.concatenate([head["offset"], np.zeros(hi - lo, np.int64)])[order]
                        spans = list(zip((place * length + begin).tolist(), (place * length + end).tolist(), strict=True))
                        cols = [pa.array(shard * per_shard + at + place), pa.array(doc), pa.array(before.astype(np.int64)), pa.array(end - begin), pa.array(np.full(len(place), shard)), pa.array((at + place) * row + RECORD.itemsize + 2 * begin), pa.array([zlib.crc32(tokens[a:b]) for a, b in spans], pa.int64())]
                        if ids:
                            wide = tokens.astype(np.int32)
                            cols.append(pa.array([wide[a:b] for a, b in spans], pa.list_(pa.int32())))
                        yield pa.RecordBatch.from_arrays(cols, names=names)
                        at += k

    return run


def read_shards(manifest: DataFrame, layout: dict, from_slot: int = 0, tokens: bool = False) -> DataFrame:
    """One row per piece of text in a sequence, in slot order within each shard; from any slot on, without reading the records before.

    ``doc_offset``: the text's ids in earlier sequences; ``byte_offset``: of the piece's first id.
    """
    schema = "slot long, doc_id long, doc_offset long, n_tokens long, shard long, byte_offset long, tokens_crc32 long" + ", tokens array<int>" * tokens
    last = F.col("shard") >= from_slot // layout["per_shard"]
    files = manifest.where(last).select("shard", "path", "n").repartition(max(1, min(-(-layout["sequences"] // layout["per_shard"]), 100_000)), "shard")
    return files.mapInArrow(_read(layout["folder"], layout, from_slot, tokens), schema)
