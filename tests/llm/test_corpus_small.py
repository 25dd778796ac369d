"""Corpus operators on small tables, against brute force: nulls, empty and long texts, ties, repeats, clashing names."""

import base64
import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lathe.llm import op01_langid, op02_mixing, op03_toxicity, op04_warc, op05_jaccard, op06_tokens, op07_binary, op08_decontam, op09_quality, op10_kdtree
from lathe.llm.graph import components
from lathe.llm.queries import vocabulary

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Names that operators use inside, and extra columns that they must not trip over.
EXTRA = ["id", "n", "key", "words", "size", "node", "shard", "rate", "seed", "_text", "_copy", "html"]


def prose(rng, n, vocab=300):
    return " ".join(f"w{rng.randrange(vocab)}" for _ in range(n))


def texts():
    rng = random.Random(5)
    base = prose(rng, 80)
    near = base.split()
    near[40] = "changed"
    short = "one two three four"
    rows = [base, base, " ".join(near), base.upper(), None, "", " \n\t ", short, short.upper(), "one two three", "!!! ???", "x" * 3000, prose(rng, 6000)]
    small = prose(rng, 20).split()
    for k in range(8):  # small sets that differ at one end
        rows.append(" ".join([*small[k // 3 :], *[f"t{k}"] * (k % 3)]))
    chain = prose(rng, 60).split()
    for k in range(6):  # links along a chain
        rows.append(" ".join(chain[2 * k :] + [f"c{j}" for j in range(2 * k)]))
    rows += [prose(rng, rng.randrange(1, 90)) for _ in range(60)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(100 + i, t, ("en", "de", None)[i % 3], None if i % 7 == 0 else f"s{i % 3}", 0) for i, t in enumerate(texts())]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit(1) for c in EXTRA})


def empty(docs):
    return docs.limit(0)


def shingles(text, k=5):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def brute_components(rows):
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), top(i)) for i in ids}


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, k) for k in range(101, 130)] + [(130, 129), (7, 7)]
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(1, 41), 1), **dict.fromkeys(range(100, 131), 100)}


def test_jaccard_equals_brute_force(docs):
    want = brute_components([(r.doc_id, r.text) for r in docs.collect()])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in op05_jaccard.jaccard_components(docs).collect()}
    assert got == want
    kept = {r.doc_id for r in op05_jaccard.one_of_each(docs).collect()}
    assert kept == {i for i, (_, c) in want.items() if i == c}


@pytest.mark.parametrize("limit", [0, 20, 64])
def test_jaccard_whatever_the_boundary(docs, monkeypatch, limit):
    monkeypatch.setattr(op05_jaccard, "boundary", lambda sets, percent: limit)
    want = brute_components([(r.doc_id, r.text) for r in docs.collect()])
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in op05_jaccard.jaccard_components(docs).collect()} == want


def test_jaccard_has_a_result_for_rows_without_an_id(docs, spark):
    rng = random.Random(12)
    long = prose(rng, 900)
    more = [(None, long), (None, long), (None, ""), (None, None), (1, long), (2, long + " end")]
    both = docs.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string")).coalesce(1)
    got = op05_jaccard.jaccard_components(both).collect()
    want = brute_components([(r.doc_id, r.text) for r in both.where("doc_id is not null").collect()])
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want and want[2][1] == 1
    n = len(shingles(long))
    assert sorted((r.n_shingles, r.component_id) for r in got if r.doc_id is None) == [(0, None), (0, None), (n, None), (n, None)]
    kept = collections.Counter(r.doc_id for r in op05_jaccard.one_of_each(both).collect())
    assert kept == {None: 4} | {i: 1 for i, (_, c) in want.items() if i == c}


def test_meetings_across_batches():
    import pyarrow as pa

    rng = random.Random(3)
    rows = sorted((rng.randrange(12), 0, rng.randrange(2), rng.randrange(5), 9, i) for i in range(40))
    cols = [pa.array([r[k] for r in rows], t) for k, t in ((0, pa.int64()), (1, pa.int32()), (2, pa.int32()), (5, pa.int64()), (4, pa.int64()), (3, pa.int32()))]
    whole = pa.RecordBatch.from_arrays([*cols, pa.array([False] * 40)], names=["key", "salt", "cls", "id", "n", "pos", "small"])
    lists = collections.Counter(r[0] for r in rows)
    pivot = {}
    for r in rows:
        pivot.setdefault((r[0], r[2]), r[5])
    want = sorted((r[0], r[5], pivot[r[0], r[2]]) for r in rows if lists[r[0]] > 1)
    for step in (1, 2, 3, 7, 40):
        out = op05_jaccard._meetings(whole.slice(k, step) for k in range(0, 40, step))
        got = [x for b in out for x in zip(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in ("key", "id", "pivot")), strict=True)]
        assert sorted(got) == want, step


def test_token_counts_equal_the_library(spark, docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    rng = random.Random(1)
    odd = [" ", "  ", "\n", " \n", "\t", "a", "the", "é", "ß", "'s", "<|endoftext|>", "12", "$$", "日本", " ", "aaaaaaa", "🎉", "\x1c", "\x85", "\r\n"]
    rows = [(i, "".join(rng.choices(odd, k=rng.randrange(30)))) for i in range(400)] + [(1000 + r.doc_id, r.text) for r in docs.collect()]
    got = {r.doc_id: r for r in op06_tokens.count_tokens(spark.createDataFrame(rows, "doc_id long, text string"), vocabulary("byte_bpe_50k.json")).collect()}
    for i, t in rows:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (n, len((t or "").encode()), n > 512), t
    assert op06_tokens.count_tokens(empty(docs), vocabulary("byte_bpe_50k.json")).count() == 0


def test_feistel_is_a_bijection():
    for n in (1, 2, 3, 10, 1000, 4096, 5000):
        assert sorted(op07_binary.Slots(n, 9).of(np.arange(n)).tolist()) == list(range(n))


def test_shards_round_trip_and_resume(docs):
    import tiktoken

    path = vocabulary("byte_bpe_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("t", pat_str=op06_tokens.PATTERN, mergeable_ranks=ranks, special_tokens={})
    manifest, layout = op07_binary.write_shards(docs, path, length=16, per_shard=64)
    rows = op07_binary.read_shards(manifest, layout, tokens=True).collect()
    assert {r.slot for r in rows} == set(range(layout["sequences"]))
    by = collections.defaultdict(list)
    for r in sorted(rows, key=lambda r: r.doc_offset):
        assert r.doc_offset == len(by[r.doc_id]) and r.n_tokens == len(r.tokens)
        by[r.doc_id] += r.tokens
    assert by == {r.doc_id: [*library.encode_ordinary(r.text or ""), 50256] for r in docs.collect()}
    # nothing stands between the texts: only a stream's last sequence is not full
    full = collections.Counter()
    for r in rows:
        full[r.slot] += r.n_tokens
    assert sum(n < 16 for n in full.values()) <= docs.rdd.getNumPartitions()
    # a piece stands where its byte_offset says, in records of equal stride
    paths = {r.shard: r.path for r in manifest.collect()}
    for r in rows[:50]:
        with open(paths[r.shard], "rb") as f:
            f.seek(r.byte_offset)
            assert np.frombuffer(f.read(2 * r.n_tokens), "<u2").tolist() == r.tokens and r.byte_offset // layout["stride"] == r.slot % 64
    late = op07_binary.read_shards(manifest, layout, from_slot=100, tokens=True).collect()
    assert sorted(late) == sorted(r for r in rows if r.slot >= 100)
    manifest, layout = op07_binary.write_shards(empty(docs), path)
    assert layout["sequences"] == 0 and op07_binary.read_shards(manifest, layout).count() == 0


def test_warc_round_trip(spark):
    rows = [(5, "u5", "<p>same</p>"), (3, "u3", "<p>same</p>"), (9, None, None), (8, "u8", ""), (1, "u\r\n1", "ünïcode\r\n\r\n" * 500), (2, "u2", "x" * 200_000), (4, "u4", "<p>same</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"id": F.lit(1), "sha": F.lit(1), "refers_to": F.lit(0)})
    manifest, folder = op04_warc.write_archives(pages)
    got = {r.page_id: r for r in op04_warc.read_archives(manifest, folder, html=True).collect()}
    first = {"<p>same</p>": 3, "": 8}
    for i, _, t in rows:
        data = (t or "").encode()
        ref = first.get(t or "", i)
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode())
        assert (got[i].record_type, got[i].refers_to) == (("response", None) if ref == i else ("revisit", ref))
        assert bytes(got[i].html) == (data if ref == i else b"")
    # smaller payloads than asked for are all responses
    manifest, folder = op04_warc.write_archives(pages, least_bytes=1)
    assert {r.page_id for r in op04_warc.read_archives(manifest, folder).where("record_type = 'revisit'").collect()} == {4, 5}
    manifest, folder = op04_warc.write_archives(pages.limit(0))
    assert op04_warc.read_archives(manifest, folder).count() == 0


def test_warc_keeps_every_payload_of_repeated_ids(spark):
    rows = [(3, "AAA"), (5, "AAA"), (5, "BBB"), (5, "CCC"), (6, "CCC"), (3, "AAA"), (None, "AAA"), (None, "DDD"), (7, "DDD"), (9, "long " * 400_000), (8, "long " * 400_000), (None, None), (5, None)]
    pages = spark.createDataFrame([(i, f"u{k}", t) for k, (i, t) in enumerate(rows)], "page_id long, url string, html string")
    manifest, folder = op04_warc.write_archives(pages.repartition(4), archive_bytes=1 << 10)
    read = op04_warc.read_archives(manifest, folder, html=True)
    assert manifest.count() > 1 and read.rdd.getNumPartitions() == manifest.count()
    got = collections.Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, bytes(r.html)) for r in read.collect())
    want = collections.Counter()
    for i, t in rows:
        data = (t or "").encode()
        ids = [j for j, u in rows if (u or "") == (t or "") and j is not None]
        first = min(ids) if ids and i is not None and i > min(ids) else None
        sha = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want[i, len(data), sha, "response" if first is None else "revisit", first, data if first is None else b""] += 1
    assert got == want


def test_quality_measures_and_verdicts(docs):
    got = {r.doc_id: r for r in op09_quality.cascade(docs).collect()}
    assert len(got) == docs.count() and op09_quality.cascade(empty(docs)).count() == 0
    for r in docs.collect():
        t = r.text or ""
        w = WORD.findall(t)
        c = collections.Counter(tuple(w[j : j + 8]) for j in range(len(w) - 7))
        inside = {j + k for j in range(len(w) - 7) if c[tuple(w[j : j + 8])] > 1 for k in range(8)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        g = got[r.doc_id]
        assert (g.n_words, g.word_chars, g.n_repeat_words, g.n_dup_lines, g.n_symbols) == (len(w), sum(map(len, w)), len(inside), len(lines) - len(set(lines)), len(re.findall(r"[#*$%&|<>]", t)))
        assert g.base_failed == (len(w) < 20 or 100 * len(inside) > 30 * len(w)) and not (g.base_failed and g.kept)


def test_quality_rules_stand_by_rejection_per_cost(docs, monkeypatch):
    one = op09_quality.Rule("none", F.lit(False))
    all_ = op09_quality.Rule("all", F.col("n_words") > 0)
    assert [r.name for r, _, _ in op09_quality.ordered(docs, [one, all_])] == ["all", "none"]
    got = op09_quality.cascade(docs, [one, all_])
    assert {r.failed_rule for r in got.collect()} == {"all", "base"}


def test_kdtree_shards(docs, spark):
    big = docs.unionAll(spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("same text").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(0).cast("long").alias("n_chars"), *[F.lit(1).alias(c) for c in EXTRA]).withColumn("doc_id", F.col("doc_id") + 10_000))
    rows = op10_kdtree.shards(big, n_shards=7).collect()
    assert len(rows) == big.count()
    total = sum(r["size"] for r in rows)
    largest = max(r["size"] for r in rows)
    by = collections.defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
    assert set(by) == set(range(7))
    for own in by.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
        assert abs(sum(r["size"] for r in own) - total / 7) <= 0.02 * total / 7 + 2 * largest
    assert op10_kdtree.shards(empty(docs), n_shards=7).count() == 0
    assert op10_kdtree.shards(docs.limit(3), n_shards=40).count() == 3


def test_poisson_mix(docs, spark):
    many = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("abcd").alias("text"), F.when(F.col("id") % 10 == 0, "rare").otherwise("hot").alias("source"))
    got = op02_mixing.mixed(many, weights={"rare": 0.6, "hot": 0.4})
    n = {r.source: r["count"] for r in got.groupBy("source").count().collect()}
    assert abs(n["rare"] - 12_000) < 600 and abs(n["hot"] - 8_000) < 500
    high = op02_mixing.mixed(many.where("doc_id < 4"), weights={"rare": 0.0, "hot": 1.0}, size=2000.0)
    assert high.where("source = 'rare'").count() == 0 and abs(high.count() - 8000) < 800
    all_ = op02_mixing.mixed(docs)
    assert set(docs.columns) - {"rate"} <= set(all_.columns) and op02_mixing.mixed(empty(docs)).count() == 0
    twice = [sorted((r.doc_id, r.copy) for r in op02_mixing.mixed(docs).select("doc_id", "copy").collect()) for _ in range(2)]
    assert twice[0] == twice[1]


@pytest.mark.parametrize("size", [40.0, 2000.0])
def test_rows_without_an_id_are_mixed_by_their_rate(spark, size):
    df = spark.createDataFrame([(None, "abcd", "hot"), (1, "abcd", "hot"), (None, "abcd", "off")], "doc_id long, text string, source string")
    got = op02_mixing.mixed(df, weights={"hot": 1.0, "off": 0.0}, size=size).collect()
    rate = 3 * size / 2
    for i in (None, 1):
        own = [r for r in got if r.doc_id == i]
        assert {r.source for r in own} == {"hot"} and abs(len(own) - rate) < 6 * rate**0.5
        assert sorted(r["copy"] for r in own) == list(range(1, len(own) + 1)) and {r.copies for r in own} == {len(own)}
        assert len({r.place for r in own}) == len(own)


def test_rows_without_an_id_draw_one_by_one(spark):
    df = spark.range(2000).select(F.lit(None).cast("long").alias("doc_id"), F.format_string("%04d", "id").alias("text"), F.lit("s").alias("source"))
    got = op02_mixing.mixed(df.union(df.limit(1).withColumn("text", F.lit(None).cast("string"))), size=0.5).collect()
    assert abs(len(got) - 1000) < 200 and len({r.text for r in got}) > 600 and {r.doc_id for r in got} == {None}


def brute_align(item, text):
    h = np.zeros((len(item) + 1, len(text) + 1), int)
    for i, a in enumerate(item):
        for j, b in enumerate(text):
            h[i + 1, j + 1] = max(0, h[i, j] + (2 if a == b else -1), h[i, j + 1] - 1, h[i + 1, j] - 1)
    return h.max()


def test_alignment_equals_brute_force():
    rng = np.random.default_rng(2)
    items = [rng.integers(0, 6, rng.integers(1, 12)).astype(np.uint64) for _ in range(60)]
    found = [rng.integers(0, 6, rng.integers(0, 30)).astype(np.uint64) for _ in range(60)]
    assert op08_decontam.align(items, found).tolist() == [brute_align(a, b) for a, b in zip(items, found, strict=True)]


def test_leaks_found_copies_edits_and_nothing_else(spark, docs):
    rng = random.Random(8)
    items = [(i, prose(rng, 30, 2000)) for i in range(20)] + [(50, None), (51, ""), (52, "two words")]
    rows, want = [], set()
    for i in range(20):
        w = items[i][1].split()
        edited = [x for k, x in enumerate(w) if k % 9] if i % 2 else [*w[:12], "put", "in", *w[12:]]
        for k, (part, hit) in enumerate(((w, True), (edited, True), (w[:4], False), (prose(rng, 30, 2000).split(), False))):
            rows.append((10 * i + k, " ".join([prose(rng, 100, 2000), *part, prose(rng, 50, 2000)])))
            if hit:
                want.add((10 * i + k, i))
    rows += [(900, None), (901, ""), (902, "two words")]
    test = spark.createDataFrame(items, "item_id long, text string").withColumn("seed", F.lit(1))
    got = op08_decontam.leaks(spark.createDataFrame(rows, "doc_id long, text string").withColumn("item", F.lit(1)), test)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want | {(902, 52)}
    assert op08_decontam.leaks(empty(docs), test).count() == 0
    assert op08_decontam.leaks(docs, test.limit(0)).count() == 0
    blocks = op08_decontam.leaks(spark.createDataFrame(rows, "doc_id long, text string"), test, block_words=200)
    assert {(r.doc_id, r.item_id) for r in blocks.collect()} == want | {(902, 52)}


@pytest.mark.parametrize("others", [0, 120_000])
@pytest.mark.parametrize("beside", [False, True])
def test_edited_copies_are_leaks_whatever_else_is_there(spark, others, beside):
    rng = random.Random(9)
    items = [" ".join(f"{'é' if k % 4 == 3 else 'e'}{i}x{rng.randrange(10**6)}" for k in range(26)) for i in range(3)]
    changed = [" ".join("other" if k % 4 == 3 else x for k, x in enumerate(t.split())) for t in items]
    rows = [(10 * i + k, f"{prose(rng, 40, 2000)} {t} {prose(rng, 40, 2000)}") for i in range(3) for k, t in enumerate([changed[i], changed[i], items[i].upper()])]
    if beside:
        rows += [(10 * i + 3, items[i]) for i in range(3)]
    test = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = spark.createDataFrame(rows, "doc_id long, text string").union(spark.range(1000, 1000 + others).select("id", F.lit("nothing of the kind")))
    assert {(r.doc_id, r.item_id) for r in op08_decontam.leaks(docs, test).collect()} == {(i, i // 10) for i, _ in rows}


def test_leaks_in_rows_without_an_id(spark):
    rng = random.Random(10)
    item, other = prose(rng, 30, 2000), prose(rng, 5000, 2000)
    rows = [(None, f"{other} {item}"), (None, f"{other} {item}"), (None, item), (None, other), (None, None), (7, f"{item} {other}"), (8, other)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    test = spark.createDataFrame([(3, item)], "item_id long, text string")
    got = op08_decontam.leaks(docs, test)
    assert got.schema["doc_id"].dataType.typeName() == "long"
    assert sorted((r.doc_id or 0, r.item_id, r.score) for r in got.collect()) == [(0, 3, 1.0), (0, 3, 1.0), (7, 3, 1.0)]
    left = op08_decontam.decontaminated(docs, test).collect()
    assert collections.Counter((r.doc_id, r.text) for r in left) == collections.Counter([(None, other), (None, None), (8, other)])


@pytest.mark.parametrize("turn", [1, -1])
def test_items_of_one_id_are_all_searched(spark, turn):
    rng = random.Random(11)
    a, b, c = (prose(rng, 30, 2000) for _ in range(3))
    test = spark.createDataFrame([(3, a), (3, b), (3, a), (4, c), (4, None)][::turn], "item_id long, text string")
    docs = spark.createDataFrame([(1, a), (2, b), (5, f"{a} {' '.join(b.split()[:20])}"), (6, c), (7, prose(rng, 30, 2000))], "doc_id long, text string")
    got = op08_decontam.leaks(docs, test)
    assert sorted((r.doc_id, r.item_id, r.score) for r in got.collect()) == [(1, 3, 1.0), (2, 3, 1.0), (5, 3, 1.0), (6, 4, 1.0)]
    assert [r.doc_id for r in op08_decontam.decontaminated(docs, test).collect()] == [7]


SYLLABLES = {"aa": ["ba", "be", "bi", "bo"], "bb": ["ka", "ke", "ki", "ko"]}


def speech(rng, lang, n):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randrange(2, 5))) for _ in range(n))


def test_language_of_texts_and_spans(spark, docs):
    rng = random.Random(4)
    rows = [(i, speech(rng, lang, 40), lang) for i in range(120) for lang in [("aa", "bb")[i % 2]]]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = op01_langid.fit(df, F.col("doc_id") < 80, steps=15, chains=500)
    more = [(500, None, "aa"), (501, "", None), (502, "12 !!", "bb"), (503, speech(rng, "aa", 20) + " " + speech(rng, "bb", 5), None), (504, speech(rng, "bb", 5000), "bb")]
    got = {r.doc_id: r for r in op01_langid.predict(df.union(spark.createDataFrame(more, df.schema)), model).collect()}
    assert all(got[i].lang_pred == lang for i, _, lang in rows)
    assert [got[i].lang_pred for i in (500, 501, 502, 503, 504)] == ["und", "und", "und", "aa", "bb"] and got[500].score == 0
    assert all(0 <= r.score <= 1 for r in got.values())
    spans = op01_langid.language_spans(spark.createDataFrame(more[3:4], df.schema), model).orderBy("word_from").collect()
    assert [(s.lang, s.word_from, s.word_to) for s in spans] == [("aa", 0, 20), ("bb", 20, 25)]
    assert op01_langid.fit(df.where("lang = 'none'")) is None
    assert {r.lang_pred for r in op01_langid.predict(docs, None).collect()} == {"und"}
    assert op01_langid.predict(empty(docs), model).count() == 0


def test_forward_backward_equals_enumeration():
    import itertools

    rng = np.random.default_rng(1)
    score, moves, start = rng.normal(size=(4, 2, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    lens = np.array([4, 2])
    p, pairs, norm = op01_langid.forward_backward(score, lens, moves, start)
    want, all_pairs, total = np.zeros((4, 2, 3)), np.zeros((3, 3)), 0.0
    for c in range(2):
        ways = {y: np.exp(start[y[0]] + sum(score[t, c, y[t]] for t in range(lens[c])) + sum(moves[a, b] for a, b in itertools.pairwise(y))) for y in itertools.product(range(3), repeat=int(lens[c]))}
        z = sum(ways.values())
        total += np.log(z)
        for y, w in ways.items():
            for t, k in enumerate(y):
                want[t, c, k] += w / z
            for a, b in itertools.pairwise(y):
                all_pairs[a, b] += w / z
    assert np.allclose(p[0], want[0]) and np.allclose(p[:, 0], want[:, 0]) and np.allclose(p[1, 1], want[1, 1])
    assert np.allclose(pairs, all_pairs) and np.isclose(norm, total)


def test_toxicity_learns_from_positive_and_unlabelled(spark, docs):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(600):
        toxic = i % 6 == 0
        words = ["".join(rng.choices("abcdefghij", k=5)) for _ in range(60)] + ([f"vile{rng.choice('abcdefgh')}{rng.choice('xyz')}" for _ in range(2)] if toxic else [])
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("toxic", F.lit(3))
    own = spark.createDataFrame(labels, "doc_id long, toxic int").withColumn("text", F.lit("clash"))
    model = op03_toxicity.fit(df, own, F.col("id") < 400)
    got = {r.doc_id: r.score for r in op03_toxicity.score(df, model).collect()}
    held = range(400, 600)
    assert all((got[i] >= 0.5) == (i % 6 == 0) for i in held)
    odd = op03_toxicity.score(docs, model).collect()
    assert len(odd) == docs.count() and all(0 <= r.score <= 1 for r in odd) and all(r.score < 0.5 for r in odd if r.doc_id in (104, 105))
    assert op03_toxicity.clean(df, model).columns == df.columns
    assert {r.doc_id for r in op03_toxicity.clean(df, model).collect()} == {i for i, s in got.items() if s < 0.5}
    assert op03_toxicity.fit(df, own.where("toxic = 0")) is None and op03_toxicity.score(docs, None).agg(F.max("score")).first()[0] == 0
    assert op03_toxicity.score(empty(docs), model).count() == 0


def test_pipeline_equals_its_operators(spark, sf0001):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, sf0001).collect()
    docs = spark.read.parquet(f"{sf0001}/documents.parquet")
    clean = corpus_pipeline.toxicity(spark, docs, sf0001)
    texts_ = [(r.doc_id, r.text) for r in clean.collect()]
    kept = {i for i, (_, c) in brute_components(texts_).items() if i == c}
    bad = {r.doc_id for r in op08_decontam.leaks(docs, spark.read.parquet(f"{sf0001}/benchmark.parquet")).collect()}
    left = docs.where(F.col("doc_id").isin(sorted(kept - bad)))
    copies = {r.doc_id: r.copies for r in op02_mixing.mixed(left).collect()}
    tokens = {r.doc_id: r.n_tokens for r in op06_tokens.count_tokens(left, vocabulary("byte_bpe_50k.json")).collect()}
    want = collections.Counter({i: n * (tokens[i] + 1) for i, n in copies.items()})
    got = collections.Counter()
    for r in rows:
        got[r.doc_id] += r.n_tokens
    assert got == want and {r.slot for r in rows} == set(range(1 + max(r.slot for r in rows)))
