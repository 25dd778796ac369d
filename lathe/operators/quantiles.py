"""Exact order statistics and moments of many columns by histogram passes: one path at every size.

Spark's exact ``median`` keeps every distinct value of a column in one
aggregation buffer, a sketch is approximate, and a sort moves all values. Here
the wanted ranks are found by selection:

1. one grouping of all columns at once by a bucket number that keeps the order
   of the values: eight buckets per power of two and sign, so at most some
   thousands per column whatever the values are. Each bucket has its rows,
   least and greatest value, mean and variance;
2. a rank that is the first or last of its bucket, or falls into one of equal
   values, is found. Any other bucket is split evenly between its least and
   greatest value by the next grouping, again for all columns and ranks at
   once. Least and greatest always part, so every pass shrinks it; doubles
   have 2^52 steps within a power of two, so a handful of passes ends it.

All passes are grouped sums in generated code: only bucket counts reach the
driver, and no value is sorted or collected.

With ``fold`` the buckets are counted by fold. The statistics *without* each
fold then come from the same passes: counts of the other folds are added up,
ranks are looked up in every complement, and moments are merged.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Buckets per power of two in the first pass, and of a bucket in the later ones.
PER_OCTAVE = 8
PARTS = 4096
_OFFSET = 1075 * PER_OCTAVE + 1  # the least double is 2^-1074


@dataclass
class Moments1:
    """Count, mean and population variance of one column."""

    n: int = 0
    mean: float = 0.0
    m2: float = 0.0

    def add(self, n: int, mean: float, var: float) -> None:
        both = self.n + n
        off = mean - self.mean
        self.m2 += var * n + off * off * self.n * n / both
        self.mean += off * n / both
        self.n = both

    @property
    def var(self) -> float | None:
        return self.m2 / self.n if self.n else None


@dataclass
class ColumnStats:
    n: int
    mean: float | None
    var_pop: float | None
    values: dict[int, float] = field(default_factory=dict)  # rank (from 1) -> value


def _octave(v: Column) -> Column:
    """A bucket number that never falls as the value rises; zero and the infinities have their own."""
    size = F.least(F.floor(F.log2(F.abs(v)) * PER_OCTAVE), F.lit(1025 * PER_OCTAVE)) + F.lit(_OFFSET)
    return F.when(v == 0, F.lit(0)).otherwise((F.signum(v) * size).cast("int"))


def _pass(df: DataFrame, segments: list[list[tuple[int, float, float] | None]], moments: bool) -> dict[int, dict[int, dict]]:
    """segment -> bucket -> fold -> (rows, least, greatest, mean, variance); a segment of None is a whole column."""
    # one row per column and value; the bucket's expression then stands in the plan once, not once a column
    used = [i for i, own in enumerate(segments) if own]
    stacked = F.expr(f"stack({len(used)}, " + ", ".join(f"{i}, _v{i}" for i in used) + ") as (i, v)")
    long = df.select("_f", stacked).where("v is not null")
    v = F.col("v")
    if segments[used[0]][0] is None:
        placed = long.select("_f", (-F.col("i") - 1).alias("s"), _octave(v).alias("b"), "v")
    else:
        found = None
        for i in used:
            for number, lo, hi in segments[i]:
                # within a bucket both ends have one sign, so the difference can't overflow
                inside = (F.col("i") == i) & (v >= F.lit(lo)) & (v <= F.lit(hi))
                at = F.struct(F.lit(number).alias("s"), F.lit(lo).alias("lo"), F.lit(hi - lo).alias("width"))
                found = F.when(inside, at) if found is None else found.when(inside, at)
        placed = long.withColumn("at", found).where("at is not null")
        b = F.least(F.floor((v - F.col("at.lo")) / F.col("at.width") * PARTS), F.lit(PARTS - 1)).cast("int")
        placed = placed.select("_f", F.col("at.s").alias("s"), b.alias("b"), "v")
    aggs = [F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")]
    if moments:
        aggs += [F.avg("v").alias("mean"), F.var_pop("v").alias("var")]
    out: dict[int, dict[int, dict]] = {}
    for r in placed.groupBy("_f", "s", "b").agg(*aggs).collect():
        out.setdefault(r["s"], {}).setdefault(r["b"], {})[r["_f"]] = (r["n"], r["lo"], r["hi"], *((r["mean"], r["var"]) if moments else ()))
    return out


def _others(by_fold: dict, without) -> list[tuple]:
    return [x for f, x in by_fold.items() if f != without]


def column_statistics(
    df: DataFrame, columns: dict[str, Column], ranks: Callable[[int], set[int]], fold: Column | None = None, folds: list | None = None, want: list[str] | None = None
) -> dict:
    """{column: {without: ColumnStats}} with the values at ``ranks(n)``.

    ``without`` is None where ``fold`` is; else each of ``folds``, the
    statistics being those of all other rows. NULLs are left out; a NaN must
    have been made NULL. Ranks are looked up for the columns in ``want`` (default: all).
    """
    names = list(columns)
    groups = [None] if fold is None else list(folds)
    table = df.select((fold if fold is not None else F.lit(0)).alias("_f"), *[columns[c].cast("double").alias(f"_v{i}") for i, c in enumerate(names)])
    out: dict = {c: {g: ColumnStats(0, None, None) for g in groups} for c in names}
    if not names:
        return out
    hist = _pass(table, [[None] for _ in names], True)
    open_ranks: list[tuple] = []  # column, group, rank, segment, rows of the group below the segment
    for i, c in enumerate(names):
        buckets = hist.get(-i - 1, {})
        for g in groups:
            m = Moments1()
            for b in sorted(buckets):
                for n, _, _, mean, var in _others(buckets[b], g):
                    m.add(n, mean, var)
            out[c][g] = ColumnStats(m.n, m.mean if m.n else None, m.var)
            if m.n and (want is None or c in want):
                open_ranks += [(i, g, k, -i - 1, 0) for k in sorted(ranks(m.n))]
    while open_ranks:
        segments: list[list] = [[] for _ in names]
        numbers: dict[tuple[int, int], int] = {}
        nxt = []
        for i, g, rank, seg, below in open_ranks:
            for b in sorted(hist[seg]):
                own = _others(hist[seg][b], g)
                n = sum(x[0] for x in own)
                if below + n < rank:
                    below += n
                    continue
                lo, hi = min(x[1] for x in own), max(x[2] for x in own)
                values = out[names[i]][g].values
                if rank == below + 1 or lo == hi:
                    values[rank] = lo
                elif rank == below + n:
                    values[rank] = hi
                else:
                    # the bucket as all folds have it, so that complements share its parts
                    if (seg, b) not in numbers:
                        numbers[seg, b] = len(numbers)
                        every = hist[seg][b].values()
                        segments[i].append((numbers[seg, b], min(x[1] for x in every), max(x[2] for x in every)))
                    nxt.append((i, g, rank, numbers[seg, b], below))
                break
        open_ranks = nxt
        if open_ranks:
            hist = _pass(table, segments, False)
    return out


def middle_ranks(n: int) -> set[int]:
    return {(n + 1) // 2, n // 2 + 1}


def median_of(stats: ColumnStats) -> float | None:
    """Mean of the two middle values, None without any."""
    if not stats.n:
        return None
    a, b = (stats.values[k] for k in ((stats.n + 1) // 2, stats.n // 2 + 1))
    return a if a == b else a + (b - a) * 0.5


def exact_medians(df: DataFrame, cols: list[str], source: Callable[[str], Column] | None = None) -> dict[str, float | None]:
    """Exact medians; ``source(c)`` maps a column name to the expression whose median is wanted (say, NaN to NULL)."""
    got = column_statistics(df, {c: source(c) if source else F.col(f"`{c}`") for c in cols}, middle_ranks)
    return {c: median_of(s[None]) for c, s in got.items()}
