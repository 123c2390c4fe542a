"""Exact distributed quantiles equal DuckDB's quantile_disc (ties, hot values, nulls, one-value groups)."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from envtrack.operators.quantiles import exact_quantiles


@pytest.fixture(scope="module")
def data():
    rnd = random.Random(7)
    rows = []
    for g in range(12):
        n = rnd.choice([1, 2, 5, 50, 400])
        for _ in range(n):
            kind = rnd.random()
            if kind < 0.1:
                v = None
            elif kind < 0.4:
                v = 0.25  # a hot value
            elif g % 3 == 0:
                v = float(rnd.randint(0, 5))  # heavy ties
            else:
                v = rnd.uniform(-1e6, 1e6)
            rows.append((f"g{g}", v, rnd.choice([1e-300, 3.5, -2.0])))
    rows.append(("tiny", 5e-324, 1.0))
    rows.append(("tiny", 1e-323, 1.0))
    return rows


@pytest.mark.parametrize("p", [0.0, 0.1, 0.5, 0.9, 1.0])
def test_grouped_matches_quantile_disc(spark, data, p):
    df = spark.createDataFrame(data, "g string, v double, w double")
    got = {r["g"]: r["value"] for r in exact_quantiles(df, ["g"], "v", p).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t (g VARCHAR, v DOUBLE, w DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?)", data)
    want = dict(con.sql(f"SELECT g, quantile_disc(v, {p}) FROM t WHERE v IS NOT NULL GROUP BY g").fetchall())
    assert got == want


def test_extreme_outliers_stay_exact(spark):
    import random as _r

    rnd = _r.Random(3)
    vals = [rnd.random() for _ in range(3000)] + [1e300, -1e300, 1e200]
    df = spark.createDataFrame([("a", v) for v in vals], "g string, v double")
    srt = sorted(vals)
    for p in (0.1, 0.5, 0.9, 0.999):
        import math

        k = max(1, math.ceil(p * len(vals)))
        assert exact_quantiles(df, ["g"], "v", p).first()["value"] == srt[k - 1]


def test_eager_values_match_grouped(spark, data):
    from envtrack.operators.quantiles import exact_quantile_values

    df = spark.createDataFrame(data, "g string, v double, w double").withColumn("all", F.lit("x"))
    for p in (0.0, 0.5, 0.9, 1.0):
        got = exact_quantile_values(df, {"v": F.col("v"), "w": F.col("w"), "none": F.lit(None)}, p)
        want = {f: exact_quantiles(df, ["all"], f, p).first()["value"] for f in ("v", "w")}
        assert got == {**want, "none": None}
    vals = [0.5] * 1000 + [1e300, -1e300]
    odd = spark.createDataFrame([(v,) for v in vals], "v double")
    assert exact_quantile_values(odd, {"v": F.col("v")}, 0.9)["v"] == 0.5


def test_infinities_and_three_jobs_at_most(spark, monkeypatch):
    from pyspark.sql import DataFrame

    from envtrack.operators.quantiles import exact_quantile_values

    inf = float("inf")
    vals = [inf, -inf, 3e12, 0.0, -0.0, 1.0, 1.0000000000000002, 5e-324, 2.0**-1022] + [i / 7 for i in range(500)]
    df = spark.createDataFrame([("a", v) for v in vals], "g string, v double")
    jobs, real = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: jobs.append(1) or real(self))
    for p in (0.0, 0.001, 0.5, 0.9, 0.999, 1.0):
        want = sorted(vals)[max(1, -(-int(p * 1e6) * len(vals) // 10**6)) - 1]
        jobs.clear()
        assert exact_quantile_values(df, {"v": F.col("v")}, p)["v"] == want
        assert len(jobs) <= 3
        assert exact_quantiles(df, ["g"], "v", p).first()["value"] == want
    only = spark.createDataFrame([(inf,)] * 5, "v double")
    assert exact_quantile_values(only, {"v": F.col("v")}, 0.9) == {"v": inf}


def test_order_image_orders_like_doubles(spark):
    import struct

    from envtrack.functions.numeric import order_image

    rnd = random.Random(2)
    vals = [struct.unpack("<d", rnd.randbytes(8))[0] for _ in range(3000)]
    vals = [v for v in vals if v == v] + [2.0**e for e in range(-1074, 1024)] + [0.0, float("inf"), float("-inf")]
    vals += [struct.unpack("<d", struct.pack("<q", struct.unpack("<q", struct.pack("<d", 2.0**e))[0] - 1))[0]
             for e in range(-1022, 1024)]
    rows = spark.createDataFrame([(v,) for v in vals], "v double").select("v", order_image(F.col("v")).alias("i")).collect()
    for r in rows:
        bits = struct.unpack("<q", struct.pack("<d", abs(r["v"])))[0]
        assert r["i"] == (bits if r["v"] >= 0 else -bits)


@pytest.mark.parametrize("bound", [0, 2, 60])
def test_groups_beyond_the_bound_are_narrowed(spark, data, monkeypatch, bound):
    """Some or all groups have more values than one task may put in order."""
    from envtrack.operators import quantiles

    con = duckdb.connect()
    con.execute("CREATE TABLE t (g VARCHAR, v DOUBLE, w DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?)", data)
    monkeypatch.setattr(quantiles, "ORDERED_VALUES", bound)
    df = spark.createDataFrame(data, "g string, v double, w double")
    for p in (0.5, 0.9):
        got = {r["g"]: r["value"] for r in exact_quantiles(df, ["g"], "v", p).collect()}
        assert got == dict(con.sql(f"SELECT g, quantile_disc(v, {p}) FROM t WHERE v IS NOT NULL GROUP BY g").fetchall())
        want, = con.sql(f"SELECT quantile_disc(v, {p}), quantile_disc(w, {p}) FROM t").fetchall()
        found = quantiles.exact_quantile_values(df, {"v": F.col("v"), "w": F.col("w")}, p)
        assert (found["v"], found["w"]) == want


def test_bounds_from_another_frame_spare_the_counting(spark, data, monkeypatch):
    from envtrack.operators import quantiles

    df = spark.createDataFrame(data, "g string, v double, w double")
    counts = quantiles.value_counts(df, ["g"], "v")
    want = {r["g"]: r["m"] for r in quantiles.quantiles_of_counts(counts, ["g"], {"m": 0.5}).collect()}
    for bound in (3, 10_000):
        monkeypatch.setattr(quantiles, "ORDERED_VALUES", bound)
        got = {r["g"]: r["m"] for r in quantiles.quantiles_of_counts(counts, ["g"], {"m": 0.5}, rows=df).collect()}
        assert got == want
