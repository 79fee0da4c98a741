"""A hot series holding a third of all rows: aggregating operators stay exact
and reduce it map-side (partial aggregation in the plan, no single-key task
holding the whole group)."""

from pyspark.sql import functions as F

from chronoline.operators import points as P
from chronoline.operators import slices as S


def _skewed(spark, n=30_000):
    # rows 0..n/3 belong to host "hot"; the rest spread over 1000 hosts; every
    # hot row is written at one of 10 instants, so each hot key repeats ~1000 times
    df = spark.range(n).select(
        F.when(F.col("id") < n // 3, F.lit("hot")).otherwise(
            F.concat(F.lit("h"), (F.col("id") % 1000).cast("string"))).alias("host"),
        (F.col("id") % 97).cast("double").alias("v"),
        F.when(F.col("id") < n // 3, F.col("id") % 10).otherwise(F.col("id")).alias("t"),
        F.col("id").alias("seq"))
    return P.to_points(df, "cpu", ["host"], ["v"], "t", keep=["seq"]), df


def test_hot_key_upsert_and_probes(spark):
    pts, raw = _skewed(spark)
    up = P.upsert_latest(pts, order=["seq"], carry=["value_double"])
    hot = {r.time_ns: r.value_double for r in up.where(F.col("series_key") == "cpu,host=hot").collect()}
    exp = {}
    for r in raw.where("host = 'hot'").collect():
        if r.t not in exp or r.seq > exp[r.t][0]:
            exp[r.t] = (r.seq, r.v)
    assert hot == {t: v for t, (_, v) in exp.items()}
    stats = {r.series_key: r.n_records for r in P.series_stats(pts).collect()}
    assert stats["cpu,host=hot"] == 10_000 and len(stats) == 1001
    plan = up._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan


def test_hot_key_wide_and_counts(spark):
    pts, _ = _skewed(spark)
    w = P.to_wide(pts, ["v"], order=["seq"]).where(F.col("series_key") == "cpu,host=hot")
    assert w.count() == 10
    c = P.range_count(pts, by_series=True).where(F.col("series_key") == "cpu,host=hot").first()
    assert (c.n_records, c.n_points) == (10_000, 10)
    b = S.incremental_batches(pts, 5).where(F.col("batch") == 0).first()
    assert b.n_records == 5_000          # hot times 0..4, 1000 rows each


def test_latest_rows_equal_the_upsert_of_their_points(spark):
    """With nulls in every pattern, and one key that holds half of the rows."""
    import random
    from chronoline.operators.points import latest_rows, to_points, upsert_latest
    r = random.Random(3)
    rows = [("hot" if i % 2 else f"h{r.randrange(50)}", i % 3, i, *(r.choice([None, r.random()]) for _ in range(3)))
            for i in range(3000)]
    df = spark.createDataFrame(rows, "host string, t bigint, seq int, a double, b double, c double")
    one = to_points(latest_rows(df, ["host", "t"], ["a", "b", "c"], ["seq"]), "m", ["host"], ["a", "b", "c"], "t")
    two = upsert_latest(to_points(df, "m", ["host"], ["a", "b", "c"], "t", keep=["seq"]), order=["seq"])
    cols = ["series_key", "field", "time_ns", "value_double"]
    assert sorted(map(tuple, one.select(*cols).collect())) == sorted(map(tuple, two.select(*cols).collect()))
