import datetime as dt

import numpy as np

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import series as ser


def _seq(spark, a, b=None):
    f = lambda v: None if v is None else float(v)
    rows = [(i, f(a[i]), None if b is None else f(b[i])) for i in range(len(a))]
    return spark.createDataFrame(rows, "i int, a double, b double")


def test_lag_backfill(spark):
    df = _seq(spark, [1.0, None, 3.0, None])
    out = [r.a_lag for r in ser.lag_backfill(df, ["a"], [], ["i"]).orderBy("i").collect()]
    assert out == [1.0, 1.0, 3.0, 3.0]


def test_sliding_correlation_fixture(spark):
    df = _seq(spark, [1, 2, 4, 3, 7, 1], [2, 1, None, 4, 5, 9])
    def swc(w):
        return [r.swc for r in ser.sliding_correlation(df, "a", "b", w, [], ["i"]).orderBy("i").collect()]
    w2 = swc(2)
    assert w2[0] is None and abs(w2[1] + 1) < 1e-9 and w2[2] is None and w2[3] is None
    assert abs(w2[4] - 1) < 1e-9 and abs(w2[5] + 1) < 1e-9
    w3 = swc(3)
    assert all(v is None for k, v in enumerate(w3) if k != 4) and abs(w3[4] - (-0.61858957)) < 1e-7
    assert all(v is None for v in swc(4)) and all(v is None for v in swc(1))


def test_sliding_correlation_constant_window_is_null(spark):
    df = _seq(spark, [1, 5, 5, 5, 5, 2], [3, 1, 2, 3, 4, 1])
    out = [r.swc for r in ser.sliding_correlation(df, "a", "b", 3, [], ["i"]).orderBy("i").collect()]
    assert out[2] is None and out[3] is None


def test_lagged_correlation_matches_numpy(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=40)
    y = np.roll(x, 2) + rng.normal(scale=0.3, size=40)
    x[5] = np.nan
    df = spark.createDataFrame([(i, float(x[i]) if not np.isnan(x[i]) else None, float(y[i])) for i in range(40)],
                               "i int, x double, y double")
    got = {r.lag: r.corr for r in ser.lagged_correlation(df, "x", "y", [0, 1, 2], [], ["i"]).collect()}
    for k in (0, 1, 2):
        xl = np.concatenate([np.full(k, np.nan), x[:40 - k]])
        ok = ~np.isnan(xl) & ~np.isnan(y)
        assert abs(got[k] - np.corrcoef(y[ok], xl[ok])[0, 1]) < 1e-9


def test_densify_weekly(spark):
    rows = [(dt.datetime(2024, 1, 7), 1.0), (dt.datetime(2024, 1, 10), 2.0), (dt.datetime(2024, 1, 21), 3.0)]
    df = spark.createDataFrame(rows, "t timestamp, v double")
    out = [(r.t.date(), r.v) for r in ser.densify_weekly(df, "t").orderBy("t").collect()]
    assert out == [(dt.date(2024, 1, 7), 1.0), (dt.date(2024, 1, 14), None), (dt.date(2024, 1, 21), 3.0)]


def _reflect_filter(x, w):
    r = (len(w) - 1) // 2
    n = len(x)
    out = []
    for i in range(n):
        s = 0.0
        for k in range(-r, r + 1):
            j = (i + k) % (2 * n)
            j = 2 * n - 1 - j if j >= n else j
            s += w[k + r] * x[j]
        out.append(s)
    return out


def test_gaussian_kernel_and_mirrored_edges(spark):
    w = ser.gaussian_weights(1.0)
    assert abs(sum(w) - 1) < 1e-12
    assert [round(v, 6) for v in w[:5]] == [0.000134, 0.004432, 0.053991, 0.241971, 0.398943]
    for n in (3, 7, 12):
        x = [float((i * 7) % 5) + 0.5 * i for i in range(n)]
        df = spark.createDataFrame([(i, x[i]) for i in range(n)], "i int, a double")
        got = [r.a_smooth for r in ser.gaussian_smooth(df, ["a"], [], ["i"]).orderBy("i").collect()]
        assert np.allclose(got, _reflect_filter(x, w), atol=1e-12)


def test_gaussian_null_poisons_neighbourhood(spark):
    x = [1.0, 2.0, 3.0, None, 5.0, 6.0, 7.0, 8.0, 9.0, 10.0, 11.0, 12.0]
    df = spark.createDataFrame([(i, x[i]) for i in range(len(x))], "i int, a double")
    got = [r.a_smooth for r in ser.gaussian_smooth(df, ["a"], [], ["i"]).orderBy("i").collect()]
    assert all(v is None for v in got[:8]) and got[8] is not None


def test_proportions_zero_total(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0), (1.0, 1.0, 2.0), (1.0, None, 1.0)], "a double, b double, c double")
    out = ser.lice_proportions(df, ["a", "b", "c"]).collect()
    assert out[0].a_proportion is None and out[1].c_proportion == 0.5 and out[2].total is None


def test_highlight_frame(spark):
    df = spark.createDataFrame([(i,) for i in range(20)], "i int")
    got = [r.i for r in ser.highlight_frame(df, 10, 5, [], ["i"]).where("in_frame").collect()]
    assert sorted(got) == [8, 9, 10, 11]


def test_densify_of_a_repeated_time_raises(spark):
    rows = [(1, dt.datetime(2020, 1, 5)), (2, dt.datetime(2020, 1, 5)), (1, dt.datetime(2020, 1, 19))]
    df = spark.createDataFrame(rows, "k int, t timestamp")
    assert ser.densify_weekly(df, "t", ["k"]).count() == 4
    with pytest.raises(Exception, match="duplicate t"):
        ser.densify_weekly(df, "t").collect()


def _long_series(spark):
    rng = np.random.default_rng(12)
    rows = []
    for k, n in ((1, 700), (2, 3), (None, 40)):
        for t in range(n):
            blank = 100 < t < 260 or rng.random() < 0.2  # gaps longer than a range
            rows.append((k, t, None if blank else float(rng.normal()), float(rng.normal()) if rng.random() > 0.1 else None,
                         dt.datetime(2000, 1, 2) + dt.timedelta(days=7 * t + int(rng.integers(0, 2)) * (t % 3))))
    return spark.createDataFrame(rows, "k int, t int, a double, b double, ts timestamp").repartition(3)


@pytest.mark.parametrize("by", [[], ["k"]])
def test_ranges_equal_the_plain_window(spark, by):
    df = _long_series(spark)
    df = df if by else df.where("k = 1").drop("k")
    order = ["t"]
    runs = {
        "shift": lambda r: ser.shift(df, "a", 3, by, order, range_rows=r),
        "backfill": lambda r: ser.lag_backfill(df, ["a", "b"], by, order, range_rows=r),
        "lagged": lambda r: ser.lagged_correlation(df, "a", "b", [0, 1, 4], by, order, range_rows=r),
        "sliding": lambda r: ser.sliding_correlation(df, "a", "b", 5, by, order, range_rows=r),
        "frame": lambda r: ser.highlight_frame(df, 10, 5, by, order, range_rows=r),
        "dense": lambda r: ser.densify_weekly(df, "ts", by, range_rows=r),
        "smooth": lambda r: ser.gaussian_smooth(df.fillna(0.0, ["a"]), ["a"], by, order, range_rows=r),
    }
    plain = lambda row: tuple(round(v, 9) if isinstance(v, float) else v for v in row)
    for name, run in runs.items():
        whole = sorted(map(repr, map(plain, run(None).collect())))
        for rows in (16, 64):
            assert sorted(map(repr, map(plain, run(rows).collect()))) == whole, (name, rows)


def test_a_single_long_series_is_spread(spark):
    df = spark.range(60_000).select(F.col("id").alias("t"), F.sin("id").alias("a"))
    out = ser.gaussian_smooth(df, ["a"], [], ["t"], range_rows=4_000)
    parts = out.groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) > 1 and sum(r["count"] for r in parts) == 60_000 and max(r["count"] for r in parts) < 50_000
