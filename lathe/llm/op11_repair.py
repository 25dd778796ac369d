"""Repair of conversations at least cost: a run-length dynamic program over min-plus transitions.

The roles' initials of a sound conversation read ``(s?(ua)+)?``. Each row is
kept (0), given the role user or assistant (1) or deleted (2; blank and
duplicate rows always); an empty user or assistant row is inserted (5); a
truncated row that isn't deleted costs 5 more. The audit names the cheapest
edits by their initials (D, I, K, R), of equal costs the least string.

A row is a symbol: the class of its role's initial (s, u, a or other; an empty
role is other and can't be kept) with its fault. Equal consecutive symbols
are a run. A symbol's transition is a 4 x 4 min-plus matrix over what the
repaired rows so far read: nothing, ``s``, ``..u``, ``..a``. Its binary powers
are kept, so a run of any length is advanced by their products; the audit
is then unrolled run by run, halving runs down to 64 rows, from the costs that
the powers give at their ends. The automaton is deterministic (a changed or an
inserted row has the one role that can follow), so the least string is found
by taking at each row the least initial among the cheapest.

On Spark, rows are slim for all that (a digest for the text) and lie in range
partitions by conversation and turn. A conversation may span many of them:
every partition sums up its segment as runs and one matrix; a conversation's
matrices are multiplied backwards; each segment unrolls its choices for every
state it may be entered in, and a forward pass picks. So no task holds a whole
long conversation. Only the digest of the repaired text, SHA-256 being a
chain, takes a conversation's rows through one task: sorted, streamed, never held.

Order: by turn, nulls first; ties by role, then by the text's SHA-256 (rows
equal in all are adjacent and count as one with a number of copies, so
that a hot row is pre-aggregated). Null roles and texts are one space, null
conversation ids a conversation of their own. Empty texts are blank. Very
long texts are hashed where they are read. Only the four named columns are
read. An empty table gives an empty result; rows with 0 copies only make their
conversation known.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lathe.llm.common import arrow_batches, cut, only

NEVER = 1 << 50
BLANKS = " \t\n\x0b\x0c\r"
#: What follows each state (nothing, s, u, a) on the initials s, u, a; an inserted or changed row goes where it can.
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
MADE = (2, 2, 3, 2)
ROLE = {2: "user", 3: "assistant"}
LEGAL = {"su", "ua", "au"}
#: Symbols: class of the initial times 2, plus 1 if truncated; 8 must be deleted.
CLASSES, MUST_GO = "sua ", 8
KNOWN = {"s": 0, "u": 1, "a": 2}

Vector = tuple[int, int, int, int]
Matrix = tuple[Vector, Vector, Vector, Vector]


def times(a: Matrix, b: Matrix) -> Matrix:
    cols = tuple(zip(*b, strict=True))
    return tuple(tuple(min(x + y for x, y in zip(row, col, strict=True)) for col in cols) for row in a)


def apply(a: Matrix, v: Vector) -> Vector:
    return tuple(min(x + y for x, y in zip(row, v, strict=True)) for row in a)


def _matrix(edges: dict[tuple[int, int], int]) -> Matrix:
    return tuple(tuple(edges.get((p, q), NEVER) for q in range(4)) for p in range(4))


ONE = _matrix({(q, q): 0 for q in range(4)})
_INSERT = _matrix({(q, q): 0 for q in range(4)} | {(q, MADE[q]): 5 for q in range(4)})
#: Up to four inserted rows: more never help.
INSERTS = times(times(_INSERT, _INSERT), times(_INSERT, _INSERT))
#: Cost of ending in each state, inserted rows included.
END: Vector = apply(INSERTS, (0, NEVER, NEVER, 0))


def row_edits(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """(initial, cost, next state) of what may be done with the row, in the order of the initials."""
    out = [("D", 2, state)]
    if symbol != MUST_GO:
        more = 5 * (symbol & 1)
        kept = NEXT[state].get(CLASSES[symbol >> 1])
        if kept is not None:
            out.append(("K", more, kept))
        out.append(("R", 1 + more, MADE[state]))
    return out


@lru_cache(None)
def power(symbol: int, k: int) -> Matrix:
    """The transition of 2^k rows of a symbol."""
    if k:
        return times(power(symbol, k - 1), power(symbol, k - 1))
    edges: dict[tuple[int, int], int] = {}
    for state in range(4):
        for _, cost, to in row_edits(symbol, state):
            edges[state, to] = min(cost, edges.get((state, to), NEVER))
    return times(INSERTS, _matrix(edges))


def before_run(symbol: int, n: int, after: Vector) -> Vector:
    """Least costs of what is left, by state, before ``n`` rows of a symbol."""
    k = 0
    while n >> k:
        if n >> k & 1:
            after = apply(power(symbol, k), after)
        k += 1
    return after


@lru_cache(100_000)
def _few_runs(runs: tuple[tuple[int, int], ...]) -> Matrix:
    return _product(runs)


def runs_matrix(runs: tuple[tuple[int, int], ...]) -> Matrix:
    """The transition of consecutive runs; short lists of runs recur from conversation to conversation."""
    return _few_runs(runs) if len(runs) <= 16 else _product(runs)


def _product(runs: tuple[tuple[int, int], ...]) -> Matrix:
    out = ONE
    for symbol, n in runs:
        k = 0
        while n >> k:
            if n >> k & 1:
                out = times(out, power(symbol, k))
            k += 1
    return out


@lru_cache(100_000)
def _unroll(symbol: int, n: int, state: int, after: Vector) -> tuple[str, int]:
    """Edits of at most 64 rows of a symbol; ``after``: costs left, least 0."""
    left = [after]
    for _ in range(n):
        left.append(apply(power(symbol, 0), left[-1]))
    out = []
    for at in range(n, 0, -1):
        while True:
            edits = row_edits(symbol, state)
            edits.insert(1, ("I", 5, MADE[state]))  # after D, before K and R
            name, _, to = next(e for e in edits if e[1] + left[at - (e[0] != "I")][e[2]] == left[at][state])
            out.append(name)
            state = to
            if name != "I":
                break
    return "".join(out), state


def unroll(symbol: int, n: int, state: int, after: Vector) -> tuple[str, int]:
    """Edits of ``n`` rows of a symbol entered in ``state``, and the state they end in."""
    if n > 64:
        half = n // 2
        first, state = unroll(symbol, n - half, state, before_run(symbol, half, after))
        second, state = unroll(symbol, half, state, after)
        return first + second, state
    least = min(after)
    return _unroll(symbol, n, state, tuple(x - least for x in after))


def unroll_runs(runs: list[tuple[int, int]], state: int, after: Vector, last: bool) -> tuple[str, int]:
    """Edits of a segment; at a conversation's end also the rows inserted there."""
    costs = [after]
    for symbol, n in reversed(runs):
        costs.append(before_run(symbol, n, costs[-1]))
    out = []
    for (symbol, n), left in zip(runs, costs[-2::-1], strict=True):
        text, state = unroll(symbol, n, state, left)
        out.append(text)
    if last:
        while END[state]:
            state = MADE[state]
            out.append("I")
    return "".join(out), state


# --- rows to symbols ---------------------------------------------------------------


def _trimmed(text: Column) -> Column:
    return F.rtrim(text, F.lit(BLANKS))


def slim_rows(rows: DataFrame) -> DataFrame:
    """``rows`` (conv, turn, role, text, copies) -> equal ones as one (conv, turn, role, digest, trunc, n, first)."""
    end = _trimmed(F.col("text"))
    slim = rows.select(
        "conv", "turn", "role", F.unhex(F.sha2("text", 256)).alias("digest"), (end == "").alias("blank"),
        (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("trunc"), "copies",
    )
    keys = ["conv", "turn", "role", "digest"]
    slim = slim.groupBy(*keys).agg(F.first("blank").alias("blank"), F.first("trunc").alias("trunc"), F.sum("copies").alias("n"))
    # texts that a conversation has at more than one turn: where it first has them
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    met = slim.where("n > 0 and not blank").groupBy(F.col("conv").alias("_c"), F.col("role").alias("_r"), F.col("digest").alias("_d"))
    again = met.agg(F.count("*").alias("_turns"), F.min(place).alias("_first")).where("_turns > 1")
    same = F.col("conv").eqNullSafe(F.col("_c")) & (F.col("role") == F.col("_r")) & (F.col("digest") == F.col("_d"))
    first = F.col("_first").isNull() | F.col("turn").eqNullSafe(F.col("_first.turn"))
    return slim.join(again, same, "left").select(*keys, "blank", "trunc", "n", first.alias("first"))


_STATS = "n_rows long, blank long, duplicate long, truncated long, illegal long, head string, tail string, low long, high long, turns long"


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted slim rows -> one row for each conversation that the partition holds."""
    schema = pa.schema([
        ("seg", pa.int64()), ("symbols", pa.list_(pa.int8())), ("lengths", pa.list_(pa.int64())), ("matrix", pa.list_(pa.int64())),
        *[(x.split()[0], pa.string() if x.endswith("string") else pa.int64()) for x in _STATS.split(", ")],
    ])
    seg = TaskContext.get().partitionId()
    kind = None
    out: list[dict] = []
    ids: list = []
    now = None

    def flush() -> pa.RecordBatch:
        for s in out:
            runs = tuple(zip(s["symbols"], s["lengths"], strict=True))
            s["matrix"] = [x for row in runs_matrix(runs) for x in row]
        data = pa.RecordBatch.from_pylist(out, schema)
        done = pa.RecordBatch.from_arrays([pa.array(ids, kind), *data.columns], names=["conv", *schema.names])
        out.clear()
        ids.clear()
        return done

    def start(conv) -> dict:
        ids.append(conv)
        out.append({"seg": seg, "symbols": [], "lengths": [], "n_rows": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "head": None, "tail": None, "low": None, "high": None, "turns": 0})
        return out[-1]

    def add(s: dict, symbol: int, n: int) -> None:
        if s["symbols"] and s["symbols"][-1] == symbol:
            s["lengths"][-1] += n
        else:
            s["symbols"].append(symbol)
            s["lengths"].append(n)

    for batch in batches:
        kind = batch.schema.field(0).type
        rows = zip(*[batch.column(k).to_pylist() for k in range(batch.num_columns)], strict=True)
        for conv, turn, role, blank, trunc, n, first in rows:
            if not out or conv != now:
                if len(out) >= 5_000:
                    yield flush()
                now = conv
                s = start(conv)
            if not n:
                continue
            initial = role[:1]
            if s["n_rows"]:
                s["illegal"] += s["tail"] + initial not in LEGAL
            else:
                s["head"] = initial
            s["illegal"] += n - 1
            s["tail"] = initial
            s["n_rows"] += n
            if turn is not None:
                s["turns"] += s["high"] != turn
                s["low"] = turn if s["low"] is None else s["low"]
                s["high"] = turn
            if blank:
                s["blank"] += n
                add(s, MUST_GO, n)
                continue
            if first:
                s["truncated"] += trunc
                add(s, 2 * KNOWN.get(initial, 3) + trunc, 1)
                n -= 1
            if n:
                s["duplicate"] += n
                add(s, MUST_GO, n)
    if out:
        yield flush()


_PLAN = "seg long, after array<long>, first boolean, last boolean, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"


def _plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A conversation's segments in order -> costs left after each, and the conversation's figures at the first."""
    names = [x.split()[0] for x in _PLAN.split(", ")]
    types = [{"array<long>": pa.list_(pa.int64()), "boolean": pa.bool_()}.get(x.split()[1], pa.int64()) for x in _PLAN.split(", ")]
    for batch in batches:
        kind, ids, cols = batch.schema.field(0).type, [], [[] for _ in names]
        for conv, segments in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            left, costs = END, []
            for s in reversed(segments):
                costs.append(left)
                m = s["matrix"]
                left = apply((m[0:4], m[4:8], m[8:12], m[12:16]), left)
            costs.reverse()
            turns, low, high, tail, sums = 0, None, None, None, {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
            for s in segments:
                for k in sums:
                    sums[k] += s[k]
                if s["n_rows"]:
                    sums["illegal"] += tail is not None and tail + s["head"] not in LEGAL
                    tail = s["tail"]
                if s["turns"]:
                    turns += s["turns"] - (high == s["low"])
                    low, high = s["low"] if low is None else low, s["high"]
            gaps = high - low + 1 - turns if turns else 0
            for k, s in enumerate(segments):
                ids.append(conv)
                head = [gaps, *sums.values(), left[0]] if not k else [None] * 6
                for c, x in zip(cols, [s["seg"], list(costs[k]), not k, k + 1 == len(segments), *head], strict=True):
                    c.append(x)
        yield pa.RecordBatch.from_arrays([pa.array(ids, kind), *[pa.array(c, t) for c, t in zip(cols, types, strict=True)]], names=["conv", *names])


def _choices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, seg, symbols, lengths, after, first, last) -> the segment's edits for each state that it may be entered in."""
    for batch in batches:
        cols = {n: batch.column(k).to_pylist() for k, n in enumerate(batch.schema.names)}
        texts, ends = [], []
        for symbols, lengths, after, first, last in zip(*[cols[c] for c in ("symbols", "lengths", "after", "first", "last")], strict=True):
            runs = list(zip(symbols, lengths, strict=True))
            got = [unroll_runs(runs, q, tuple(after), last) if q == 0 or not first else (None, None) for q in range(4)]
            texts.append([t for t, _ in got])
            ends.append([q for _, q in got])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.list_(pa.string())), pa.array(ends, pa.list_(pa.int32()))], names=["conv", "seg", "texts", "ends"])


def audits(rows: DataFrame) -> DataFrame:
    """``rows`` (conv, turn, role, text, copies) -> (conv, gaps, blank, duplicate, truncated, illegal, cost, audit), every conversation once."""
    arrow_batches(rows.sparkSession)
    kind = rows.schema["conv"].dataType.simpleString()
    keys = ["conv", "turn", "role", "digest"]
    laid = slim_rows(rows).repartitionByRange(*keys).sortWithinPartitions(*keys).drop("digest")
    segments = cut(laid.mapInArrow(_segments, f"conv {kind}, seg long, symbols array<tinyint>, lengths array<long>, matrix array<long>, {_STATS}"))
    stats = [x.split()[0] for x in _STATS.split(", ")]
    listed = segments.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("seg", "matrix", *stats))).alias("segments"))
    plan = cut(listed.mapInArrow(_plan, f"conv {kind}, {_PLAN}"))
    same = F.col("conv").eqNullSafe(F.col("_c")) & (F.col("seg") == F.col("_s"))
    after = plan.select(F.col("conv").alias("_c"), F.col("seg").alias("_s"), "after", "first", "last")
    chosen = segments.select("conv", "seg", "symbols", "lengths").join(after, same).drop("_c", "_s")
    chosen = chosen.mapInArrow(_choices, f"conv {kind}, seg long, texts array<string>, ends array<int>")
    listed = chosen.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("seg", "texts", "ends"))).alias("s"))
    empty = F.struct(F.lit(0).alias("q"), F.array().cast("array<string>").alias("parts"))
    walked = F.aggregate("s", empty, lambda a, x: F.struct(F.get(x["ends"], a["q"]).alias("q"), F.concat(a["parts"], F.array(F.get(x["texts"], a["q"]))).alias("parts")))
    audit = listed.select(F.col("conv").alias("_c"), F.array_join(walked["parts"], "").alias("audit"))
    figures = plan.where("first").drop("seg", "after", "first", "last")
    return figures.join(audit, F.col("conv").eqNullSafe(F.col("_c"))).drop("_c")


# --- the audit applied to the rows ---------------------------------------------------

_FIGURES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


class _Follow:
    """Steps through a conversation's edits along with its rows."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state = audit, 0, 0

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            self.state = MADE[self.state]
            yield "I", ROLE[self.state], ""

    def row(self, role: str, text: str, copies: int) -> Iterator[tuple[str, str, str]]:
        for _ in range(copies):
            yield from self.inserted()
            edit = self.audit[self.at]
            self.at += 1
            if edit == "K":
                self.state = NEXT[self.state][role[:1]]
                yield "K", role, text
            elif edit == "R":
                self.state = MADE[self.state]
                yield "R", ROLE[self.state], text


def _followed(batch: pa.RecordBatch):
    return zip(*[batch.column(k).to_pylist() for k in range(batch.num_columns)], strict=True)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    done: list[list] = []
    follow = now = digest = None
    kind = None

    def put(rows) -> None:
        for _, role, text in rows:
            if now[-1]:
                digest.update(b"\n")
            now[-1] = True
            digest.update(f"{role}:{text}".encode())

    def end() -> None:
        put(follow.inserted())
        done.append([*now[:-1], digest.hexdigest()])

    def flush() -> pa.RecordBatch:
        cols = list(zip(*done, strict=True)) if done else [[]] * 9
        done.clear()
        types = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["conv", *_FIGURES, "repaired_sha256"])

    for batch in batches:
        kind = batch.schema.field(0).type
        for conv, is_row, role, text, copies, *figures in _followed(batch):
            if is_row:
                put(follow.row(role, text, copies))
            else:
                if follow:
                    end()
                follow, digest, now = _Follow(figures[-1]), hashlib.sha256(), [conv, *figures, False]
        if done:
            yield flush()
    if follow:
        end()
        yield flush()


def _turned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv", "place", "edit", "role", "text"]
    out: list[tuple] = []
    follow = now = kind = None
    place = 0

    def put(rows) -> None:
        nonlocal place
        for row in rows:
            out.append((now, place, *row))
            place += 1

    def flush() -> pa.RecordBatch:
        cols = list(zip(*out, strict=True)) if out else [[]] * 5
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [kind, pa.int64(), *[pa.string()] * 3], strict=True)], names=names)

    for batch in batches:
        kind = batch.schema.field(0).type
        for conv, is_row, role, text, copies, *figures in _followed(batch):
            if is_row:
                put(follow.row(role, text, copies))
            else:
                if follow:
                    put(follow.inserted())
                follow, now, place = _Follow(figures[-1]), conv, 0
        yield flush()
    if follow:
        put(follow.inserted())
        yield flush()


def _streamed(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Each conversation's figures, then its rows in order, in one task."""
    figures = [F.col(c) for c in _FIGURES]
    none = [F.lit(None).cast(found.schema[c].dataType).alias(c) for c in _FIGURES]
    heads = found.select("conv", F.lit(False).alias("_row"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), F.lit(0).alias("copies"), *figures, F.lit(None).cast(rows.schema["turn"].dataType).alias("_turn"), F.lit(None).cast("binary").alias("_digest"))
    body = rows.where("copies > 0").select("conv", F.lit(True), "role", "text", F.col("copies").cast("int"), *none, "turn", F.unhex(F.sha2("text", 256)))
    both = heads.union(body).repartition("conv")
    return both.sortWithinPartitions("conv", "_row", "_turn", "role", "_digest").drop("_turn", "_digest")


def repair_digests(rows: DataFrame) -> DataFrame:
    """One row per conversation: figures, audit and the digest of the repaired ``role:text`` lines."""
    kind = rows.schema["conv"].dataType.simpleString()
    schema = f"conv {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    return _streamed(rows, audits(rows)).mapInArrow(_hashed, schema)


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The repaired conversations: (conv, place, edit, role, text), ``edit`` K, R or I."""
    kind = rows.schema["conv"].dataType.simpleString()
    return _streamed(rows, audits(rows)).mapInArrow(_turned, f"conv {kind}, place long, edit string, role string, text string")


def rows_of(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The columns under the operator's names, null roles and texts as one space, one copy of each row."""
    got = only(conversations, conv=conv, turn=turn, role=role, text=text)
    return got.select("conv", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), F.lit(1).alias("copies"))


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with planted faults, by the CRC-32 of ``conv:turn`` modulo 20: 0 dropped, 1 emptied, 2 without ``.!?``, 3 twice, 4 from the user."""
    name = F.concat(F.coalesce(F.col("conv").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    fault = F.crc32(name.cast("binary")) % 20
    return rows.select(
        "conv", "turn", F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2 * F.col("copies")).otherwise(F.col("copies")).cast("int").alias("copies"),
    )
