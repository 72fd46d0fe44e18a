import math
import random

from pyspark.sql import functions as F

from tidewatch.operators import joins as jn


def _hav(a, b, c, d):
    p1, p2 = math.radians(a), math.radians(c)
    h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(d - b) / 2) ** 2
    return 2 * jn.EARTH_RADIUS_KM * math.asin(min(1.0, math.sqrt(h)))


def _check_knn(spark, sites, stations, k, **kw):
    s_df = spark.createDataFrame(sites, "localityno long, lat double, lon double")
    t_df = spark.createDataFrame(stations, "sourceid string, lat double, lon double")
    got = {}
    for r in jn.nearest_stations(s_df, t_df, k=k, **kw).collect():
        got.setdefault(r.localityno, []).append((r.rank, r.sourceid))
    for key, la, lo in sites:
        brute = sorted(((_hav(la, lo, sl, so), sid) for sid, sl, so in stations))[:k]
        assert [sid for _, sid in brute] == [sid for _, sid in sorted(got[key])], key


def test_knn_matches_brute_force(spark):
    rnd = random.Random(3)
    stations = [(f"SN{i}", rnd.uniform(58, 71), rnd.uniform(4, 17)) for i in range(60)]
    sites = [(i, rnd.uniform(57, 72), rnd.uniform(3, 18)) for i in range(80)]
    _check_knn(spark, sites, stations, 5)
    _check_knn(spark, sites, stations, 5, cell_deg=0.25)


def test_knn_hot_cell_and_fewer_stations_than_k(spark):
    rnd = random.Random(5)
    hot = [(f"H{i}", 63.0 + rnd.uniform(0, 0.01), 10.0 + rnd.uniform(0, 0.01)) for i in range(30)]
    far = [(f"F{i}", rnd.uniform(58, 71), rnd.uniform(4, 17)) for i in range(10)]
    sites = [(i, rnd.uniform(58, 71), rnd.uniform(4, 17)) for i in range(25)]
    _check_knn(spark, sites, hot + far, 5)
    _check_knn(spark, sites[:3], far[:3], 5)


def test_join_weekly_left_and_inner(spark):
    weekly = spark.createDataFrame([(1, "2020_2", 6.75), (1, "2020_53", 1.0)], "m int, week string, air double")
    lice = spark.createDataFrame([(1, "2020_2", 0.4)], "m int, year_week string, lice double")
    left = {r.week: r.lice for r in jn.join_weekly(weekly, lice, ["m"]).collect()}
    assert left == {"2020_2": 0.4, "2020_53": None}
    assert jn.join_weekly(weekly, lice, ["m"], how="inner").count() == 1


def test_sites_and_stations_without_coordinates(spark):
    sites = spark.createDataFrame([(1, 60.0, 5.0), (2, None, 5.0), (3, 61.0, None)], "localityno long, lat double, lon double")
    stations = spark.createDataFrame([("A", 60.1, 5.0), ("B", None, 5.0)], "sourceid string, lat double, lon double")
    got = {(r.localityno, r["rank"], r.sourceid) for r in jn.nearest_stations(sites, stations, k=2).collect()}
    assert got == {(1, 1, "A"), (2, None, None), (3, None, None)}
    none = jn.nearest_stations(sites, stations.where("false"), k=2).collect()
    assert sorted(r.localityno for r in none) == [1, 2, 3] and all(r["rank"] is None for r in none)


def test_knn_sparse_stations_and_far_sites_end(spark):
    """Two stations a tenth of a degree apart on one latitude; sites degrees and half a globe away."""
    stations = [("A", 60.0, 5.0), ("B", 60.0, 5.1)]
    _check_knn(spark, [(1, 60.0, 10.0), (2, -60.0, -175.0), (3, 60.0, 5.06)], stations, 1)
    _check_knn(spark, [(1, 65.0, 5.1)], stations, 1, capacity=1)


def test_knn_across_the_date_line_and_the_poles(spark):
    rnd = random.Random(9)
    stations = [(f"S{i:03d}", rnd.uniform(-89, 89), rnd.choice([-1, 1]) * rnd.uniform(150, 180)) for i in range(150)]
    stations += [(f"P{i}", 89.5 + i / 100, rnd.uniform(-180, 180)) for i in range(20)] + [("W", 0.0, -180.0)]
    sites = [(i, rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for i in range(120)] + [(500, 0.0, 179.99), (501, 0.0, -179.99), (502, 90.0, 0.0), (503, -90.0, 7.0)]
    for capacity in (1, 7, 64):
        _check_knn(spark, sites, stations, 4, capacity=capacity)


def test_knn_dense_cells_are_split(spark):
    """A third of the stations in one spot, many at the very same place, and sites that share places."""
    rnd = random.Random(11)
    stations = [(f"D{i:05d}", 63.0 + rnd.uniform(0, 1e-3), 10.0 + rnd.uniform(0, 1e-3)) for i in range(1500)]
    stations += [(f"E{i:05d}", 63.0005, 10.0005) for i in range(1500)] + [(f"F{i:05d}", rnd.uniform(58, 71), rnd.uniform(4, 17)) for i in range(1500)]
    sites = [(i, 63.0 + rnd.uniform(0, 1e-3), 10.0 + rnd.uniform(0, 1e-3)) for i in range(20)] + [(100 + i, 63.0005, 10.0005) for i in range(3)]
    sites += [(200 + i, rnd.uniform(57, 72), rnd.uniform(3, 18)) for i in range(20)]
    _check_knn(spark, sites, stations, 5, capacity=16)
    st = spark.createDataFrame(stations, "_sid string, _slat double, _slon double")
    cells, members = jn.station_tree(st.where("_sid < 'E'"), 16)
    sizes = [r["count"] for r in members.groupBy("level", "ci", "cj").count().collect()]
    assert sum(sizes) == 1500 and max(sizes) <= 16


def test_boxes_bound_distances(spark):
    rnd = random.Random(2)
    rows = []
    for _ in range(400):
        s, n = sorted(rnd.uniform(-90, 90) for _ in range(2))
        w, e = sorted(rnd.uniform(-180, 180) for _ in range(2))
        inside = [(rnd.uniform(s, n), rnd.uniform(w, e)) for _ in range(8)] + [(s, w), (s, e), (n, w), (n, e)]
        la, lo = rnd.uniform(-90, 90), rnd.uniform(-180, 180)
        for a, o in inside:
            rows.append((la, lo, s, n, w, e, _hav(la, lo, a, o)))
    df = spark.createDataFrame(rows, "la double, lo double, b_s double, b_n double, b_w double, b_e double, d double")
    far = math.pi * jn.EARTH_RADIUS_KM - jn._to_box_km(-F.col("la"), jn._wrapped(F.col("lo") + 180.0), "b")
    got = df.select("d", jn._to_box_km(F.col("la"), F.col("lo"), "b").alias("near"), far.alias("far")).collect()
    assert all(r.near - 1e-6 <= r.d <= r.far + 1e-6 for r in got)


def test_longitudes_in_any_turn(spark):
    sites = spark.createDataFrame([(1, 10.0, 179.5), (2, 10.0, -540.5)], "localityno long, lat double, lon double")
    stations = spark.createDataFrame([("A", 10.0, 541.0), ("B", 10.0, 170.0)], "sourceid string, lat double, lon double")
    got = {(r.localityno, r["rank"], r.sourceid) for r in jn.nearest_stations(sites, stations, k=2).collect()}
    assert got == {(1, 1, "A"), (1, 2, "B"), (2, 1, "A"), (2, 2, "B")}
