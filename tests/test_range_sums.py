"""Sums over the pairs of range joins, against the pairs themselves, and in numbers that no list of pairs could hold."""

import random

from pyspark.sql import functions as F

from orfloom.operators import ranges


def test_spans_at_counts_the_pairs(spark):
    rng = random.Random(1)
    points = [(i, rng.randint(-20, 60)) for i in range(120)] + [(500, None)]
    spans = [(x, x + rng.randint(-3, 25)) for x in (rng.randint(-30, 60) for _ in range(90))] + [(None, 5), (5, None), (-1000, 1000)]
    got = ranges.spans_at(spark.createDataFrame(points, "i int, p int"), spark.createDataFrame(spans, "a int, b int"), "p", "a", "b").select("i", "n").collect()
    want = {i: sum(1 for a, b in spans if None not in (a, b) and a <= p < b) for i, p in points if p is not None}
    assert dict(map(tuple, got)) == {i: n for i, n in want.items() if n}


def test_points_within_sums_up_the_pairs(spark):
    rng = random.Random(2)
    for scale in (1.0, 0.37):
        points = [(rng.choice("xy"), rng.randint(-70, 200) * scale, rng.randint(0, 999)) for _ in range(150)] + [("x", None, -5)]
        spans = [(i % 200, rng.choice("xyz"), x * scale, (x + rng.choice([0, 1, 2, 4, 7, 8, 16, 31, 64, 300])) * scale) for i, x in ((i, rng.randint(-90, 200)) for i in range(260))]
        got = ranges.points_within(spark.createDataFrame(spans, "k int, g string, a double, b double"), spark.createDataFrame(points, "g string, p double, e int"), ["k"], "a", "b", "p", "e", ["g"]).collect()
        want = {}
        for k, g, a, b in spans:
            for h, p, e in points:
                if p is not None and g == h and a <= p < b:
                    n, least = want.get(k, (0, e))
                    want[k] = (n + 1, min(least, e))
        assert {r["k"]: (r["n"], r["e"]) for r in got} == want


def test_track_mean_is_that_of_the_pairs(spark):
    rng = random.Random(3)
    intervals = [(i % 6, x, x + rng.randint(1, 60)) for i in range(90) for x in [rng.randint(-40, 300)]]
    intervals.append(intervals[0])
    track = [(x, x + rng.randint(1, 30), rng.choice([None, 1.5, -2.25, 1e3])) for x in (rng.randint(-40, 300) for _ in range(60))]
    for more in ([], [(10, 20, float("nan"))], [(200, 205, float("inf"))], [(200, 205, float("inf")), (203, 204, float("-inf"))]):
        t = spark.createDataFrame(track + more, "t_start int, t_end int, value double").where("value is not null")
        i = spark.createDataFrame(intervals, "k int, start int, end int")
        hits = ranges.range_join(i, t, 16, "start", "end", "t_start", "t_end")
        over = F.least("end", "t_end") - F.greatest("start", "t_start")
        w = F.col("end") - F.col("start")
        per = hits.groupBy("k", "start", "end").agg((F.sum(F.col("value") * over) / F.sum(over)).alias("m"))
        want = per.groupBy("k").agg((F.sum(F.col("m") * w) / F.sum(w)).alias("mean"), F.sum(w).alias("width"), F.count("*").alias("n_intervals"))
        rows = lambda df: sorted((r["k"], str(round(r["mean"], 7) + 0.0), r["width"], r["n_intervals"]) for r in df.collect())
        assert rows(ranges.weighted_track_mean(i, t, ["k"], 16)) == rows(want)


def test_pairs_are_counted_where_none_could_be_formed(spark):
    n = 300_000  # 9e10 pairs
    points, spans = spark.range(n).select("id", (F.col("id") % 50).alias("p")), spark.range(n).select("id", (F.col("id") % 10).alias("a"), F.lit(100).alias("b"))
    assert ranges.spans_at(points, spans, "p", "a", "b").agg(F.sum("n")).first()[0] == sum((n // 50) * (n // 10) * min(p + 1, 10) for p in range(50))
    r = ranges.points_within(spans, points.select("p", F.col("id").alias("least")), ["id"], "a", "b", "p", "least").agg(F.sum("n"), F.sum("least")).first()
    assert tuple(r) == (sum((n // 10) * (n // 50) * (50 - a) for a in range(10)), (n // 10) * 45)
    m = ranges.weighted_track_mean(spans.select((F.col("id") % 2).alias("k"), F.col("a").alias("start"), F.col("b").alias("end")), points.select(F.col("p").alias("t_start"), (F.col("p") + 1).alias("t_end"), F.lit(2.0).alias("value")), ["k"], 16)
    assert sorted((r["k"], round(r["mean"], 9)) for r in m.collect()) == [(0, 2.0), (1, 2.0)]
