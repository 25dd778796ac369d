"""WARC archives of individually compressed records with a shared Zstandard dictionary.

The dictionary is trained on records of a bounded sample of pages (``sample_bytes``,
picked by a hash of the id) and stands in front of every archive in a skippable
frame; each record is a frame of its own, so one can be read without the rest.
Of records with equal payloads (at least ``least_bytes`` long) the one with the
smallest id is a ``response``, the others are ``revisit`` records that refer to it
and hold no payload. Equal payloads are found by their SHA-1, counted before the
shuffle; ids of a payload that very many pages share are spread over salts.

Each task writes archives of about ``archive_bytes`` under names of its own attempt
and returns them for the manifest, a table in the shared folder: files of lost or
repeated attempts are in no manifest. Null pages are empty payloads. An id may
repeat: each of its rows is judged by its own payload, and rows equal in both
have one verdict (both hold the payload, where the id is the smallest). Rows
without an id are responses. Pages are read whole, however long; a very long
one is a record of its own batch. An empty table gives no archive; other
columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathe.llm.common import arrow_batches, cut, only, scratch, small_enough, unit
from lathe.llm.files import attempt_name, opened

#: The skippable frame that holds a dictionary (fixed by the format of .warc.zst).
MAGIC = 0x184D2A5D
SALTS = 16


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _head(kind: str, fields: list[tuple[str, str]], size: int) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *[f"{k}: {v}" for k, v in fields], f"Content-Length: {size}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def record(page: int | None, url: str | None, payload: bytes, refers_to: int | None, digest: str, date: str) -> bytes:
    name = "" if page is None else page
    fields = [("WARC-Record-ID", f"<urn:page:{name}>"), ("WARC-Date", date), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if url:
        fields.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields.append(("Content-Type", "application/http; msgtype=response"))
    if refers_to is None:
        body, kind = http + payload, "response"
    else:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
        body, kind = http, "revisit"
    return _head(kind, fields, len(body)) + body + b"\r\n\r\n"


def dictionary(samples: list[bytes], size: int = 64 << 10) -> bytes:
    """A trained dictionary; with too few samples to train on, their plain contents."""
    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _writer(folder: str, words: bytes, level: int, archive_bytes: int, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = opened(folder)
        pack = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(words) if words else None)
        info = _head("warcinfo", [("WARC-Date", date), ("Content-Type", "application/warc-fields")], 23) + b"format: WARC File 1.1\r\n\r\n\r\n"
        file, path, size, n = None, "", 0, 0

        def ended() -> pa.RecordBatch:
            file.close()
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([n], pa.int64()), pa.array([size], pa.int64())], names=["path", "records", "bytes"])

        for batch in batches:
            ids, urls, pages, refs = (batch.column(batch.schema.get_field_index(c)) for c in ("id", "url", "html", "refers_to"))
            for k in range(batch.num_rows):
                if file is None:
                    path, size, n = f"{base}/{attempt_name('pages.warc.zst')}", 0, 0
                    file = store.open_output_stream(path)
                    start = struct.pack("<II", MAGIC, len(words)) + words + pack.compress(info)
                    file.write(start)
                    size += len(start)
                text = pages[k].as_py()
                payload = text.encode("utf-8", "surrogatepass") if text else b""
                frame = pack.compress(record(ids[k].as_py(), urls[k].as_py(), payload, refs[k].as_py(), _digest(payload), date))
                file.write(frame)
                size += len(frame)
                n += 1
                if size >= archive_bytes:
                    yield ended()
                    file = None
        if file is not None:
            yield ended()

    return run


def payload_groups(pages: DataFrame, least_bytes: int) -> DataFrame:
    """(id, sha, n, refers_to) of the pages whose payload (by digest and length) a page with a smaller id has."""
    keys = pages.select("id", "sha", "n").where(F.col("n") >= least_bytes)
    many = keys.groupBy("sha", "n").agg(F.min("id").alias("first"), F.count("*").alias("c")).where("c > 1")
    salted = many.select("sha", "n", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    own = keys.where("id is not null").withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    return own.join(salted, ["sha", "n", "salt"]).where("id <> first").select("id", "sha", "n", F.col("first").alias("refers_to")).distinct()


def write_archives(
    pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0, sample_bytes: int = 4 << 20, level: int = 3, archive_bytes: int = 64 << 20, date: str = "1970-01-01T00:00:00Z",
) -> tuple[DataFrame, str]:
    """The manifest (path, records, bytes), a table in the shared folder, and the archives' folder."""
    spark = pages.sparkSession
    rows = only(pages, id=id_col, url=url_col, html=html_col).withColumn("id", F.col("id").cast("long")).withColumn("url", F.col("url").cast("string"))
    total = rows.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    picked = rows.where(unit(F.col("id"), "warc") < min(1.0, sample_bytes / max(total, 1))).select("id", "url", "html").toPandas()
    samples, size = [], 0
    for r in picked.sort_values("id").itertuples(index=False):
        payload = r.html.encode() if isinstance(r.html, str) else b""
        samples.append(record(None if np.isnan(r.id) else int(r.id), r.url, payload, None, _digest(payload), date))
        size += len(samples[-1])
        if size > 2 * sample_bytes:
            break
    words = dictionary(samples)
    folder = folder or scratch(spark)
    store, base = opened(folder)
    store.create_dir(base, recursive=True)
    # a row is judged by its own payload: ids may repeat with different ones
    rows = rows.withColumns({"sha": F.sha1(F.coalesce("html", F.lit("")).cast("binary")), "n": F.coalesce(F.octet_length("html"), F.lit(0))})
    revisits = small_enough(cut(payload_groups(rows, least_bytes)))
    arrow_batches(spark)
    out = rows.join(revisits, ["id", "sha", "n"], "left").select("id", "url", "html", "refers_to")
    return cut(out.mapInArrow(_writer(folder, words, level, archive_bytes, date), "path string, records long, bytes long")), folder


def _record(stream: io.BufferedReader) -> tuple[dict[str, str], bytes] | None:
    line = stream.readline()
    while line == b"\r\n":
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"not a WARC record: {line[:40]!r}")
    fields = {}
    while (line := stream.readline()) not in (b"\r\n", b""):
        name, _, value = line.decode("utf-8", "surrogatepass").rstrip("\r\n").partition(": ")
        fields[name] = value
    body = stream.read(int(fields["Content-Length"]))
    if len(body) != int(fields["Content-Length"]):
        raise ValueError("an archive ends inside a record")
    return fields, body


def _reader(folder: str, html: bool):
    names = ["id", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["html"] * html

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = opened(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with store.open_input_stream(path) as f:
                    magic, size = struct.unpack("<II", f.read(8))
                    if magic != MAGIC:
                        raise ValueError(f"{path} has no dictionary frame")
                    words = f.read(size)
                    unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(words) if words else None)
                    stream = io.BufferedReader(unpack.stream_reader(f, read_across_frames=True), 1 << 20)
                    rows: list[list] = [[] for _ in names]
                    held = 0
                    while (got := _record(stream)) is not None:
                        fields, body = got
                        kind = fields["WARC-Type"]
                        if kind == "warcinfo":
                            continue
                        head, _, payload = body.partition(b"\r\n\r\n")
                        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        if kind == "response" and _digest(payload) != digest:
                            raise ValueError(f"{path}: payload and digest of {fields['WARC-Record-ID']} differ")
                        length = int(head.rpartition(b"Content-Length: ")[2])
                        page, ref = (fields.get(k, "<urn:page:>")[10:-1] for k in ("WARC-Record-ID", "WARC-Refers-To"))
                        for out, x in zip(rows, (int(page) if page else None, length, digest, kind, int(ref) if ref else None, payload), strict=False):
                            out.append(x)
                        held += len(payload)
                        if len(rows[0]) >= 4096 or held > 4 << 20:
                            yield _batch(rows, names)
                            rows, held = [[] for _ in names], 0
                    if rows[0]:
                        yield _batch(rows, names)

    return run


def _batch(rows: list[list], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(rows, kinds, strict=False)], names=names)


def read_archives(manifest: DataFrame, folder: str, html: bool = False, id_col: str = "page_id") -> DataFrame:
    """One row per record of the archives; ``html``: with the payload (none for revisits)."""
    schema = "id long, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", html binary" * html
    # an explicit number, as the paths' few bytes say nothing of the archives' size: a task for each
    files = manifest.select("path").repartition(max(1, min(manifest.count(), 100_000)))
    return files.mapInArrow(_reader(folder, html), schema).withColumnRenamed("id", id_col)
