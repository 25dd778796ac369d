"""Conversation repair, merge replay and the Merkle manifest against brute force and the library."""

import base64
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from lathe.llm import op11_repair, op12_replay, op13_merkle
from lathe.llm.queries import vocabulary

# --- op11 --------------------------------------------------------------------------

FOLLOWS = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
GIVEN = (2, 2, 3, 2)
GIVEN_ROLE = {2: "user", 3: "assistant"}


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if k == 0:
            continue
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        out += [(conv, turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    return out


def with_inserts(best):
    best = dict(best)
    for _ in range(4):
        for q in list(best):
            cost, audit, lines = best[q]
            way = (cost + 5, audit + "I", (*lines, GIVEN_ROLE[GIVEN[q]] + ":"))
            if GIVEN[q] not in best or way[:2] < best[GIVEN[q]][:2]:
                best[GIVEN[q]] = way
    return best


def brute_repair(rows):
    """All ways, row by row: of each state the cheapest, then least, audit."""
    out, hurt = {}, damage(rows)
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in hurt if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))
        seen, faults = set(), []
        for _, _, role, text in own:
            end = text.rstrip(" \t\n\x0b\x0c\r")
            faults.append("b" if not end else "d" if (role, text) in seen else "t" if end[-1] not in ".!?" else "")
            seen.add((role, text))
        initials = [r[2][:1] for r in own]
        turns = sorted({r[1] for r in own if r[1] is not None})
        best = {0: (0, "", ())}
        for (_, _, role, text), fault in zip(own, faults, strict=True):
            after = {}
            for q, (cost, audit, lines) in with_inserts(best).items():
                ways = [(cost + 2, audit + "D", lines, q)]
                if fault in ("", "t"):
                    more = 5 * (fault == "t")
                    if role[:1] in FOLLOWS[q] and role:
                        ways.append((cost + more, audit + "K", (*lines, f"{role}:{text}"), FOLLOWS[q][role[0]]))
                    ways.append((cost + 1 + more, audit + "R", (*lines, f"{GIVEN_ROLE[GIVEN[q]]}:{text}"), GIVEN[q]))
                for *way, to in ways:
                    if to not in after or tuple(way[:2]) < after[to][:2]:
                        after[to] = tuple(way)
            best = after
        best = with_inserts(best)
        cost, audit, lines = min(best[q] for q in (0, 3) if q in best)
        gaps = turns[-1] - turns[0] + 1 - len(turns) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials[:-1], initials[1:], strict=True))
        out[conv] = (gaps, *[faults.count(f) for f in "bdt"], illegal, cost, audit, "\n".join(lines))
    return out


def conversations():
    rng = random.Random(3)
    rows = []
    for conv in range(150):
        for _ in range(rng.randrange(0, 14)):
            turn = None if rng.random() < 0.05 else rng.randrange(0, 12)
            rows.append((conv, turn, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "", "unit"]), rng.choice(["Hi.", "Ok", "Yes!", "no", " ", "", None, "a b?\n", "z", "long " * 3000 + "end."])))
    rows += [(None, t, rng.choice(["user", "assistant"]), f"x{t}.") for t in range(30)]
    # one conversation holds most rows, one has runs of hundreds of equal symbols
    rows += [(1000, t, rng.choice(["user", "user", "assistant", "system"]), rng.choice(["same.", f"t{t}.", f"t{t}"])) for t in range(1500)]
    rows += [(1001, t, "user", f"only user {t}.") for t in range(900)]
    rows += [(1002, 7, "user", "again.")] * 200
    return rows


@pytest.fixture(scope="module")
def chats(spark):
    df = spark.createDataFrame(conversations(), "conv_id long, turn long, role string, text string")
    # extra columns whose names the operator uses inside
    return df.withColumns({c: F.lit(1) for c in ("conv", "copies", "seg", "digest", "first", "_row", "n")})


def repair_input(df):
    return op11_repair.damaged(op11_repair.rows_of(df))


@pytest.mark.parametrize("parts", ["4", "23"])
def test_repair_equals_brute_force(spark, chats, parts):
    want = brute_repair([tuple(r) for r in chats.select("conv_id", "turn", "role", "text").collect()])
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    # without coalescing, long conversations span many partitions
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", parts == "4")
    try:
        got = {r[0]: tuple(r)[1:] for r in op11_repair.repair_digests(repair_input(chats)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", True)
    assert got == {c: (*w[:-1], hashlib.sha256(w[-1].encode()).hexdigest()) for c, w in want.items()}


def test_repaired_turns_read_as_the_digest_says(chats):
    want = brute_repair([tuple(r) for r in chats.select("conv_id", "turn", "role", "text").collect()])
    lines = {}
    for r in sorted(op11_repair.repaired_turns(repair_input(chats)).collect(), key=lambda r: r.place):
        lines.setdefault(r.conv, []).append((r.edit, f"{r.role}:{r.text}"))
    for conv, w in want.items():
        assert "\n".join(x for _, x in lines.get(conv, [])) == w[-1]
        assert "".join(e for e, _ in lines.get(conv, [])) == w[-2].replace("D", "")


def test_repair_of_nothing(chats):
    assert op11_repair.repair_digests(repair_input(chats.limit(0))).count() == 0
    assert op11_repair.repaired_turns(repair_input(chats.limit(0))).count() == 0


def test_run_powers_equal_single_steps():
    for symbol in range(9):
        left = op11_repair.END
        for n in range(1, 200):
            left = op11_repair.apply(op11_repair.power(symbol, 0), left)
            assert op11_repair.before_run(symbol, n, op11_repair.END) == left
            assert op11_repair.apply(op11_repair.runs_matrix(((symbol, n),)), op11_repair.END) == left


# --- op12 --------------------------------------------------------------------------


@pytest.fixture(scope="module")
def multi():
    import public_tokenizers
    import tiktoken

    path = vocabulary("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return path, public_tokenizers.PATTERN, tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def scripts():
    rng = random.Random(8)
    letters = "abcdefghiABC 1239.,!?'s\n\t\x0b\x0c\r\x1c\x1f\x85 ᠎ ​éüß漢字かなжщاب́😀-_ "
    out = ["", None, " ", "a", "aaaaaaaaaaaaaa", "a" * 5000, "<|endoftext|>", "  x  y ", "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(30_000))]
    return out + ["".join(rng.choice(letters) for _ in range(rng.randrange(0, 60))) for _ in range(3000)]


def test_replay_equals_the_library(spark, multi):
    path, pattern, library = multi
    rows = [(k if k % 50 else None, t, 1) for k, t in enumerate(scripts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids long")
    ids = [library.encode_ordinary(t or "") for _, t, _ in rows]
    want = sorted((-1 if k is None else k, len(x), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for (k, t, _), x in zip(rows, ids, strict=True))
    got = op12_replay.digests(docs, path, pattern).na.fill(-1).collect()
    assert sorted(map(tuple, got)) == want
    encoded = op12_replay.encode(docs, path, pattern)
    assert sorted(r.ids for r in encoded.collect()) == sorted(ids)
    assert sorted(bytes(r.bytes) for r in op12_replay.decode(encoded, path).collect()) == sorted((t or "").encode() for _, t, _ in rows)
    assert op12_replay.digests(docs.limit(0), path, pattern).count() == 0


def test_words_side_by_side_equal_words_alone(multi):
    words = [(t or "").encode() for t in scripts()]
    vocabulary_ = op12_replay.Vocabulary(multi[0])
    assert op12_replay.replay(vocabulary_, words) == [op12_replay.encode_alone(vocabulary_, w) for w in words]


def test_a_pair_whose_rank_is_past(tmp_path):
    """``abc`` (rank 256) may arise from ``ab`` (257), which is merged later than it."""
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 256, b"ab": 257, b"cd": 258}
    path = tmp_path / "small.tiktoken"
    path.write_bytes(b"\n".join(base64.b64encode(k) + b" " + str(v).encode() for k, v in ranks.items()))
    import tiktoken

    library = tiktoken.Encoding("t", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})
    vocabulary_ = op12_replay.Vocabulary(str(path))
    for text in ("abcd", "abab", "abcabcd", "xabcdab", "cdabcd"):
        assert op12_replay.replay(vocabulary_, [b"ab", text.encode(), b"cd"])[1] == library.encode_ordinary(text), text


# --- op13 --------------------------------------------------------------------------


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def layers(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][k : k + 2]) for k in range(0, len(out[-1]), 2)])
    return out


def way_up(tree, at):
    for layer in tree[:-1]:
        yield at & 1, layer[at ^ 1] if at ^ 1 < len(layer) else None
        at >>= 1


def brute_proofs(rows):
    def leaf(r, more=0):
        values = (r.doc_id, r.source, r.lang, r.n_chars if r.n_chars is None else r.n_chars + more, r.text)
        return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])

    groups = {}
    for r in rows:
        groups.setdefault(r.lang, []).append((r.doc_id is not None, r.doc_id or 0, leaf(r), r))
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda t: t[:3])
        trees[name] = layers([t[2] for t in groups[name]])
    top = layers([trees[name][-1][0] for name in names])
    out = []
    for place, name in enumerate(names):
        for at, (_, _, own, r) in enumerate(groups[name]):
            way = [*way_up(trees[name], at), *way_up(top, place)]
            now = leaf(r, 1) if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0 else own
            for right, other in way:
                now = digest(now) if other is None else digest(other, now) if right else digest(now, other)
            out.append((r.doc_id, own, trees[name][-1][0], top[-1][0], digest(*[s for _, s in way if s]), now, now == top[-1][0]))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def leaves(spark):
    rng = random.Random(4)
    rows = [(k, f"text {k} é", rng.choice(["en"] * 8 + ["de", "fr", None, "Zz", "é"]), rng.choice(["a", None]), rng.choice([None, 3, 50])) for k in range(700)]
    rows += [(None, None, None, None, None), (None, "x", None, "s", 3), (5, "", "only", "s", None), (800, "y" * 200_000, "en", "s", 1), *[(900, "same", "en", "s", 2)] * 3]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit(1) for c in ("id", "n", "_at", "root", "leaf")})


@pytest.mark.parametrize("levels", [1, 3, 12])
def test_proofs_equal_brute_force(leaves, levels):
    got = sorted(map(tuple, op13_merkle.document_proofs(leaves.repartition(5), levels).collect()), key=str)
    assert got == brute_proofs(leaves.collect())


@pytest.mark.parametrize("n", [0, 1, 2])
def test_proofs_of_few(leaves, n):
    few = leaves.limit(n)
    assert sorted(map(tuple, op13_merkle.document_proofs(few).collect()), key=str) == brute_proofs(few.collect())


def test_witnesses_grow_by_appends():
    tree = op13_merkle.Appender(5)
    rows = [hashlib.sha256(bytes([k])).digest() for k in range(21)]
    for n, row in enumerate(rows, 1):
        tree.append(row)
        # open subtrees are those of the binary digits of n; witnesses reach to their roots
        assert [1 << level for level, _, _ in tree.open] == [1 << b for b in range(5, -1, -1) if n >> b & 1]
        for level, lo, root in tree.open:
            for k in range(lo, lo + (1 << level)):
                assert op13_merkle.fold(rows[k], k - lo, 1 << level, tree.witnesses()[k]) == root
    root = tree.close(op13_merkle.height(21))
    assert root.hex() == layers([r.hex() for r in rows])[-1][0]
    assert all(op13_merkle.fold(r, k, 21, tree.witnesses()[k]) == root for k, r in enumerate(rows))
