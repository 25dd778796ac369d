"""Quality rules as a short-circuit cascade, ordered by rejection per cost; DataFrame functions only.

Texts that fail the base rule (too few words, or too many in repeated windows)
are rejected first. The other rules stand in one ``CASE``, so a text is judged by
rules only up to the first that rejects it. Their order comes from a bounded
sample (``sample_docs`` documents, picked by a hash of the id): each rule's cost is
the time of a job that evaluates it there less that of one that evaluates none,
its selectivity the share it rejects; rules with the most rejection per second
come first. The order changes the work, never the verdict.

Null and empty texts have no words and fail the base rule. Equal texts get equal
verdicts. Empty tables give empty results, with the rules as listed. Other
columns are not read.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lathe.llm.common import cut, only, unit

BLANK = r"[\x20\x09-\x0D]+"
#: Words of a window, and the characters counted as symbols (fixed values).
WINDOW, SYMBOLS = 8, "[#*$%&|<>]"


@dataclass
class Rule:
    """``rejects`` is true for a text to be rejected; it may use the columns of ``measured``."""

    name: str
    rejects: Column


def rules() -> list[Rule]:
    n = F.col("n_words")
    long_words = F.size(F.filter("words", lambda w: F.length(w) > 60))
    lettered = F.size(F.filter("words", lambda w: w.rlike(r"\p{L}")))
    return [
        Rule("word_length", (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 15 * n)),
        Rule("symbols", 5 * F.col("n_symbols") > 2 * n),
        Rule("repeated_lines", 2 * F.col("n_dup_lines") > F.col("n_lines")),
        Rule("long_words", 20 * long_words > n),
        Rule("letters", 2 * lettered < n),
        Rule("distinct_words", 20 * F.size(F.array_distinct("words")) < n),
    ]


def measured(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, words, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words of every whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    df = only(documents, id=id_col, text=text_col).select("id", text.alias("text"), F.array_remove(F.split(text, BLANK), "").alias("words"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = df.select("id", "words", F.octet_length("text").alias("bytes"), F.octet_length(F.regexp_replace("text", SYMBOLS, "")).alias("plain"), lines.alias("lines"))
    n = F.size("words")
    windows = F.when(n >= WINDOW, F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("words", i, WINDOW))))
    df = df.select(
        "id", "words", n.cast("long").alias("n_words"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"), (F.col("bytes") - F.col("plain")).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), windows.alias("windows"))
    # only texts with an equal pair of windows are sorted
    again = F.size(F.array_distinct("windows")) < F.size("windows")
    df = df.withColumn("sorted", F.when(again, F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    s = F.col("sorted")
    marked = F.transform("sorted", lambda x, k: F.when((F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]), x["i"]))
    df = df.withColumn("starts", F.sort_array(F.array_compact(marked)))
    covered = F.aggregate("starts", F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")), lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n")), lambda a: a["n"])
    return df.select("id", "words", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def ordered(documents: DataFrame, given: list[Rule], sample_docs: int = 2000, id_col: str = "doc_id", text_col: str = "text") -> list[tuple[Rule, float, float]]:
    """The rules with seconds on the sample and share rejected, most rejection per second first."""
    docs = only(documents, id=id_col, text=text_col)
    n = docs.count()
    if not n:
        return [(r, 0.0, 0.0) for r in given]
    sample = cut(measured(docs.where(unit(F.col("id"), "quality") < sample_docs / n), "id", "text")).where(~base_failed())

    def seconds(value: Column) -> tuple[float, float]:
        best, share = float("inf"), 0.0
        for _ in range(2):
            began = time.perf_counter()
            # every column is read in each job, so that only the rule differs
            row = sample.agg(F.avg(value.cast("double")), F.sum(F.size("words") + F.col("word_chars") + F.col("n_symbols") + F.col("n_lines") + F.col("n_dup_lines"))).first()
            best, share = min(best, time.perf_counter() - began), row[0] or 0.0
        return best, share

    none, _ = seconds(F.lit(False))
    found = []
    for r in given:
        took, share = seconds(r.rejects)
        found.append((r, max(took - none, 1e-4), share))
    return sorted(found, key=lambda x: -x[2] / x[1])


def cascade(documents: DataFrame, given: list[Rule] | None = None, sample_docs: int = 2000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The measures, ``base_failed``, ``kept`` and ``failed_rule`` (any rule that rejected; null if kept) of every row."""
    verdict = F.when(base_failed(), F.lit("base"))
    for r, _, _ in ordered(documents, given or rules(), sample_docs, id_col, text_col):
        verdict = verdict.when(r.rejects, F.lit(r.name))
    got = measured(documents, id_col, text_col).withColumn("failed_rule", verdict)
    return got.select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed().alias("base_failed"), F.isnull("failed_rule").alias("kept"), "failed_rule")
