"""Range joins and window functions over sliced groups, against plain Python and Spark's own windows."""

import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidelog.operators import halo, intervals, ordered
from tidelog.operators.halo import lag, lead, numbered, over_range, over_rows, with_rank
from tidelog.operators.intervals import overlap_join, range_join


def sides(n=400, m=150, seed=1):
    draw = random.Random(seed)
    points = [(i, draw.choice([50, draw.randrange(0, 300), None])) for i in range(n)]  # a third of them on one value
    spans = [(j, a, a + draw.choice([-3, 0, 1, 5, 40, 1000])) for j, a in enumerate(draw.randrange(-50, 350) for _ in range(m))]
    return points + points[:5], spans + [(m, None, 5), (m + 1, 5, None), (m + 2, -10**6, 10**6)] + spans[:3]


@pytest.mark.parametrize("cell,full", [(1000, 20_000), (16, 20)])
def test_range_join(spark, monkeypatch, cell, full):
    monkeypatch.setattr(intervals, "CELL", cell)
    monkeypatch.setattr(intervals, "FULL", full)
    points, spans = sides()
    left = spark.createDataFrame(points, "i long, at long").repartition(4)
    right = spark.createDataFrame(spans, "j long, opens long, closes long").repartition(3)
    found = range_join(left, right, "at", "opens", "closes")
    want = sorted((i, t, j, a, b) for i, t in points for j, a, b in spans if None not in (t, a, b) and a <= t <= b)
    assert sorted(map(tuple, found.collect())) == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert range_join(left.limit(0), right, "at", "opens", "closes").collect() == []
    assert range_join(left, right.limit(0), "at", "opens", "closes").collect() == []
    with pytest.raises(ValueError):
        range_join(left, right.withColumnRenamed("j", "i"), "at", "opens", "closes")


def written(spark, df, monkeypatch):
    """Rows that a range join stores, by the name they are stored under, and the rows it gives."""
    rows, kept = {}, {intervals: intervals.store, ordered: ordered.store}

    def count(stored, name, *rest, **options):
        out = kept[intervals](stored, name, *rest, **options)
        rows[name] = rows.get(name, 0) + out.count()
        return out

    for module in kept:
        monkeypatch.setattr(module, "store", count)
    found = df().count()
    return rows, found


def test_copies_do_not_outgrow_the_input(spark, monkeypatch):
    """Twice the points and twice the intervals over the same span: four times the pairs, but twice what is stored and dealt."""
    monkeypatch.setattr(intervals, "CELL", 10)
    dealt = []
    for n in (300, 600):
        left = spark.range(n).select(F.col("id").alias("i"), (F.col("id") * 1000 / n).cast("long").alias("at"))
        right = spark.range(n).select(F.col("id").alias("j"), (F.col("id") * 1000 / n).cast("long").alias("opens")).withColumn("closes", F.col("opens") + 100)
        with monkeypatch.context() as patched:
            rows, pairs = written(spark, lambda: range_join(left, right, "at", "opens", "closes"), patched)
        dealt.append((pairs, sum(rows.values())))
    assert dealt[1][0] > 3.9 * dealt[0][0]
    assert dealt[1][1] < 2.2 * dealt[0][1] and dealt[1][1] < 7 * 600


def test_each_side_is_stored_once(spark, monkeypatch):
    """Points are stored in their order and intervals with the cells they reach; neither is stored again to be laid on a line."""
    monkeypatch.setattr(intervals, "CELL", 50)
    left = spark.range(400).select(F.col("id").alias("i"), (F.col("id") % 100).alias("at"))
    right = spark.range(300).select(F.col("id").alias("j"), (F.col("id") % 90).alias("opens"), (F.col("id") % 90 + F.col("id") % 7).alias("closes"))
    rows, pairs = written(spark, lambda: range_join(left, right, "at", "opens", "closes"), monkeypatch)
    assert pairs == sum(1 for i in range(400) for j in range(300) if j % 90 <= i % 100 <= j % 90 + j % 7)
    assert rows.pop("sliced") == 400 and rows.pop("held") == 300 and sum(rows.values()) < 20


@pytest.mark.parametrize("kind,other", [
    ("long", "int"), ("int", "double"), ("double", "double"), ("decimal(9,2)", "long"), ("timestamp", "timestamp"), ("date", "timestamp"), ("string", "string"),
    ("string collate UTF8_LCASE", "string collate UTF8_LCASE"), ("struct<a:int,b:double>", "struct<a:int,b:double>"),
])
def test_range_join_compares_as_spark_does(spark, monkeypatch, kind, other):
    monkeypatch.setattr(intervals, "CELL", 4)
    draw = random.Random(4)

    def value(of):
        if of == "double":
            return draw.choice([float("nan"), float("inf"), -0.0, 0.0, None, draw.randrange(9) / 2])
        if "string" in of:
            return draw.choice(["", "é", "z", "Z", "\U0001f600", "\uffee", None, "abAB"[draw.randrange(4)] + draw.choice("cD")])
        if "struct" in of:
            return draw.choice([None, (1, 2.0), (1, None), (None, 1.0), (draw.randrange(3), draw.randrange(3) / 2)])
        return draw.choice([None, draw.randrange(-5, 9)])

    def frame(n, names, of):
        plain = of if of == "double" or "struct" in of else "string" if "string" in of else "int"
        rows = [(i, *[value(of) for _ in names]) for i in range(n)]
        df = spark.createDataFrame(rows, ", ".join([f"{'i' if len(names) == 1 else 'j'} long", *[f"{c} {plain}" for c in names]])).repartition(3)
        shown = (lambda c: F.date_add(F.lit("2024-03-30").cast("date"), F.col(c))) if of in ("date", "timestamp") else F.col
        return df.select(df.columns[0], *[shown(c).cast(of).alias(c) if "collate" not in of else F.expr(f"{c} COLLATE UTF8_LCASE").alias(c) for c in names])

    left, right = frame(120, ["at"], kind), frame(60, ["opens", "closes"], other)
    found = range_join(left, right, "at", "opens", "closes")
    want = left.join(right, (F.col("at") >= F.col("opens")) & (F.col("at") <= F.col("closes")))
    assert found.schema == want.schema and want.count() > 20
    keys = [sorted((r.i, r.j) for r in df.select("i", "j").collect()) for df in (found, want)]
    assert keys[0] == keys[1]


def test_overlap_join(spark, monkeypatch):
    monkeypatch.setattr(intervals, "CELL", 8)
    draw = random.Random(2)
    a = [(i, s, s + draw.choice([0, 2, 30])) for i, s in enumerate(draw.choice([10, draw.randrange(100)]) for _ in range(60))]
    b = [(j, s, s + draw.choice([-1, 0, 3, 50])) for j, s in enumerate(draw.randrange(100) for _ in range(40))]
    left, right = spark.createDataFrame(a, "i long, a1 long, a2 long"), spark.createDataFrame(b, "j long, b1 long, b2 long")
    found = overlap_join(left, right, ("a1", "a2"), ("b1", "b2"))
    assert sorted(map(tuple, found.collect())) == sorted((*x, *y) for x in a for y in b if y[1] <= y[2] and x[1] <= y[2] and x[2] >= y[1])


def grouped(spark, n=500):
    draw = random.Random(3)
    rows = [(draw.choice(["busy", "busy", "a", None]), i, draw.choice([7, 7, i // 3, None]), draw.choice([1.5, 2.5, float(i % 40), None])) for i in range(n)]
    return spark.createDataFrame(rows, "k string, o long, t long, v double").repartition(5)


@pytest.mark.parametrize("block", [50_000, 7])
def test_windows_equal_sparks_own(spark, monkeypatch, block):
    monkeypatch.setattr(halo, "BLOCK", block)
    df = grouped(spark)
    rows = numbered(df, ["k"], ["o"])
    framed = over_rows(rows, ["k"], {
        "earlier": lag(F.col("t"), 2), "later": lead(F.col("t"), 3), "n": (F.count("*"), -2, 0), "high": (F.max("v"), -4, -1), "around": (F.sum("o"), -9, 5),
    })
    told = with_rank(over_range(framed, ["k"], "t", {"near": (F.lit(1), -5, 2), "total": (F.col("o"), -30, -1)}), ["k"], "v", "place")
    by = Window.partitionBy("k")
    own, spans = by.orderBy("o"), by.orderBy("t")
    want = df.select(
        "k", "o", (F.row_number().over(own) - 1).cast("long").alias("_number"), F.lag("t", 2).over(own).alias("earlier"), F.lead("t", 3).over(own).alias("later"),
        F.count("*").over(own.rowsBetween(-2, 0)).alias("n"), F.max("v").over(own.rowsBetween(-4, -1)).alias("high"), F.sum("o").over(own.rowsBetween(-9, 5)).alias("around"),
        F.count("*").over(spans.rangeBetween(-5, 2)).alias("near"), F.coalesce(F.sum("o").over(spans.rangeBetween(-30, -1)), F.lit(0)).alias("total"),
        F.rank().over(by.orderBy("v")).cast("long").alias("place"),
    )
    got = told.select(*want.columns)
    got = told.select(*want.columns)
    nulls = F.col("t").isNull()  # SQL's range of null rows is the null rows, whatever the bounds
    assert got.exceptAll(want).isEmpty() and got.count() == want.count()
    plan = told._jdf.queryExecution().executedPlan().toString()
    assert not re.findall(r"hashpartitioning\(k#\d+, \d+", plan)  # by the group alone
