"""Work of the weekly panels and of the landed observations: what is shuffled, searched and written."""

import datetime as dt
import os
import random

from pyspark.sql import functions as F

from tidewatch.operators import aggregates as agg
from tidewatch.operators import joins as jn
from tidewatch.plans import pipelines as pl
from tidewatch.schemas import ELEMENTS
from tidewatch.sources import files as fs

OBSERVATION = "municipalityno int, sourceid string, referencetime timestamp, elementid string, value double, unit string, timeoffset string"


def _observations(stations, days=20):
    start = dt.datetime(2020, 3, 2)
    return [(m, s, start + dt.timedelta(days=d), e, float(10 * i + d % 7 + j), "u", f"PT{o}H")
            for i, (m, s) in enumerate(stations) for d in range(days) for j, e in enumerate(ELEMENTS) for o in range(2)]


def test_sites_of_the_same_stations_share_a_panel(spark, monkeypatch):
    """the days go to each set of chosen stations once, whatever the number of its sites."""
    stations = [("A", 60.0, 5.0), ("B", 60.0, 5.2), ("C", 68.0, 15.0)]
    sites = spark.createDataFrame([(i, 60.0 + i / 1000, 5.1, 1) for i in range(12)] + [(50, 68.0, 15.1, 1)],
                                  "localityno int, lat double, lon double, municipalityno int")
    obs = spark.createDataFrame(_observations([(1, "A"), (1, "B"), (1, "C")]), OBSERVATION)
    lice = spark.createDataFrame([], "municipalityno int, year int, week int, avgadultfemalelice double, avgmobilelice double, "
                                     "avgstationarylice double, seatemperature double, localityname string")
    seen = []
    resample = agg.weekly_resample
    monkeypatch.setattr(agg, "weekly_resample", lambda df, ts, by, **kw: (seen.append(df.select(*by).distinct().count()), resample(df, ts, by, **kw))[1])
    out = pl.combine_nearest(obs, lice, sites, spark.createDataFrame(stations, "sourceid string, lat double, lon double"), k=2,
                             as_of=dt.date(2020, 3, 31)).collect()
    assert seen == [2]
    # weeks after the first; A is the smallest station but for the site beside C, whose second is B
    air = {(r.localityno, str(r.referencetime.date())): r.mean_air_temperature for r in out}
    weeks = ["2020-03-15"]
    assert set(air) == {(s, w) for s in [*range(12), 50] for w in weeks}
    assert {air[s, "2020-03-15"] for s in range(12)} == {3.0} and air[50, "2020-03-15"] == 13.0


def test_places_are_searched_in_groups(spark, monkeypatch):
    """near places go down the tree together, and one by one where a group has too many stations."""
    rnd = random.Random(4)
    stations = [(f"S{i:04d}", rnd.uniform(58, 71), rnd.uniform(4, 17)) for i in range(400)]
    sites = [(i, rnd.uniform(58, 71), rnd.uniform(4, 17)) for i in range(600)]
    st = spark.createDataFrame(stations, "sourceid string, lat double, lon double")
    si = spark.createDataFrame(sites, "localityno int, lat double, lon double")
    searched = []
    near = jn._near_cells
    monkeypatch.setattr(jn, "_near_cells", lambda g, *a: (searched.append(g.select("_g").distinct().count()), near(g, *a))[1])
    order = ["localityno", "rank"]
    grouped = jn.nearest_stations(si, st, k=3).orderBy(*order).collect()
    assert searched[0] < 100
    monkeypatch.setattr(jn, "_MANY_STATIONS", 20)
    assert jn.nearest_stations(si, st, k=3).orderBy(*order).collect() == grouped
    assert searched[2] > 100
    far = si.crossJoin(st.withColumnsRenamed({"lat": "b", "lon": "c"})).withColumn("d", jn.haversine_km(F.col("lat"), F.col("lon"), F.col("b"), F.col("c")))
    best = {}
    for r in far.collect():
        best.setdefault(r.localityno, []).append((r.d, r.sourceid))
    assert [(r.localityno, r.sourceid) for r in grouped] == [(s, x[1]) for s in sorted(best) for x in sorted(best[s])[:3]]


def test_only_the_first_stations_are_averaged(spark, monkeypatch):
    """of a municipality's day only the observations of the smallest (unit, station) reach the mean's shuffle."""
    rows = _observations([(1, f"S{i:02d}") for i in range(30)], 7) + _observations([(None, "S00"), (2, "T")], 7)
    rows += [(1, None, rows[0][2], ELEMENTS[0], 99.0, "u", "PT0H"), (2, "U", rows[0][2], ELEMENTS[1], 1.0, None, "PT0H")]
    averaged = []
    mean_by = agg.mean_by
    monkeypatch.setattr(agg, "mean_by", lambda df, *a, **kw: (averaged.append(df.count()), mean_by(df, *a, **kw))[1])
    wide = {(r.municipalityno, r.referencetime.day): r for r in pl.daily_wide(spark.createDataFrame(rows, OBSERVATION), ["municipalityno"]).collect()}
    assert averaged == [2 * 7 * 4 * 2 - 2]  # two municipalities, days, elements, time offsets; two cells have one row
    assert len(wide) == 14 and (wide[1, 2][ELEMENTS[0]], wide[1, 3][ELEMENTS[0]]) == (99, 1)
    assert (wide[2, 2][ELEMENTS[1]], wide[2, 3][ELEMENTS[1]]) == (1, 12)


def test_landed_documents_can_be_compressed(spark, scratch):
    """compressed files hold the same documents."""
    docs = spark.range(1000).select(F.col("id").cast("string").alias("json"), (F.col("id") % 2).alias("part"))
    plain, packed = (fs.land(docs, scratch, ["part"], c) for c in ("none", "gzip"))
    size = lambda path: sum(os.path.getsize(os.path.join(d, f)) for d, _, fs_ in os.walk(path) for f in fs_ if f.startswith("part"))
    assert size(packed) < size(plain)
    assert sorted(map(tuple, spark.read.text(packed).collect())) == sorted(map(tuple, spark.read.text(plain).collect()))
