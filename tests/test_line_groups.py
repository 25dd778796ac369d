"""The feature table's line groups: spread over tasks that grow with the table, with the same rows."""

from lathe.sources import tables

COLS = ["l_orderkey", "l_suppkey", "l_quantity", "l_discount", "l_tax", "l_returnflag"]


def test_tasks_grow_with_the_lines(spark, monkeypatch):
    """A task's groups grew with the table: map-side by split, then as the merged shuffle partitions came (F15 to F22)."""
    rows = [(k % 90 if k % 13 else None, k % 7 if k % 11 else None, float(k % 50), k % 10 / 100, k % 8 / 100, "RAN"[k % 3]) for k in range(2000)]
    lines = spark.createDataFrame(rows, COLS)
    few = tables.line_aggregates(lines)
    monkeypatch.setattr(tables, "LINES_PER_TASK", 100)
    assert tables.line_partitions(lines) == 20
    many = tables.line_aggregates(lines)
    assert many.rdd.getNumPartitions() == 20
    order = lambda df: [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.orderBy("l_orderkey").collect()]
    got = order(many)
    assert got == order(few) and len(got) == len({r[0] for r in rows})
    one = [r for r in rows if r[0] == 5]
    mine = next(r for r in got if r[0] == 5)
    assert mine[3] == sum(r[2] for r in one) and mine[6] == len(one) and mine[5] == len({r[1] for r in one})
