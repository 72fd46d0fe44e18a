import datetime as dt
import json


import pytest

from tidewatch.operators import reshape as rs
from tidewatch.plans import pipelines as pl
from tidewatch.schemas import DETAIL_DOC, OBSERVATION_DOC, SUMMARY_DOC


def _docs(spark, docs, schema):
    return rs.parse_json_text(spark.createDataFrame([(json.dumps(d),) for d in docs], "json string"), schema)


def test_flatten_localities_summary_small(spark):
    docs = [{"year": 2020, "week": 2, "localities": [{"localityNo": 1, "name": "A", "lat": 63.5},
                                                     {"localityNo": 2, "name": "B", "lat": 69.0}]},
            {"year": 2020, "week": 3, "localities": []},
            {"year": 2020, "week": 4}]
    out = pl.year_summary(_docs(spark, docs, SUMMARY_DOC)).orderBy("localityno").collect()
    assert [(r.localityno, r.name, r.year, r.week) for r in out] == [(1, "A", 2020, 2), (2, "B", 2020, 2)]
    assert out[0].date == dt.date(2020, 1, 13)
    assert all(c == c.lower() for c in out[0].asDict())


def test_element_field_wins_over_parent(spark):
    df = spark.createDataFrame([(2020, [(2021, "x")])], "year int, localities array<struct<year:int,name:string>>")
    r = rs.flatten_localities(df).first()
    assert r.year == 2021 and r.name == "x"


def test_extract_detail_null_safe(spark):
    docs = [{"localityName": "A", "localityWeek": None},
            {"localityName": "B", "localityWeek": {"avgAdultFemaleLice": 0.4, "seaTemperature": 7.6},
             "aquaCultureRegister": {"speciesList": ["Laks", "Ørret"]}}]
    out = rs.extract_detail(_docs(spark, docs, DETAIL_DOC)).collect()
    assert out[0].avgAdultFemaleLice is None and out[0].speciesList is None
    assert out[1].avgAdultFemaleLice == 0.4 and out[1].speciesList == ["Laks", "Ørret"]


def test_flatten_observations(spark):
    docs = [{"data": [{"sourceId": "SN1", "referenceTime": "2020-01-05T00:00:00.000Z",
                       "observations": [{"elementId": "mean(air_temperature P1D)", "value": 1.5, "unit": "degC",
                                         "timeOffset": "PT0H"},
                                        {"elementId": "mean(air_temperature P1D)", "value": 2.5, "unit": "degC",
                                         "timeOffset": "PT6H"}]},
                      {"sourceId": "SN2", "referenceTime": "2020-01-06T00:00:00.000Z", "observations": []}]}]
    out = rs.flatten_observations(_docs(spark, docs, OBSERVATION_DOC)).collect()
    assert len(out) == 2 and {r.timeoffset for r in out} == {"PT0H", "PT6H"}
    assert out[0].referencetime == dt.datetime(2020, 1, 5)


def test_pivot_first_smallest_unit_source_wins(spark):
    rows = [("d1", "e", 1.0, "C", "SN2"), ("d1", "e", 2.0, "C", "SN1"), ("d1", "f", 9.0, "C", "SN9")]
    df = spark.createDataFrame(rows, "k string, elementid string, value double, unit string, sourceid string")
    r = rs.pivot_first(df, ["k"], "elementid", ["e", "f", "g"], order_cols=["unit", "sourceid"]).first()
    assert (r.e, r.f, r.g) == (2.0, 9.0, None)


def test_drop_all_null_columns_and_lower_rename(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, None, None)], "A int, B string, C string")
    out = rs.drop_all_null_columns(rs.lower_columns(df))
    assert out.columns == ["a", "c"]
    assert rs.rename_columns(out, {"a": "alpha", "zz": "q"}).columns == ["alpha", "c"]


def test_union_by_name(spark):
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([(2, "y")], "x int, z string")
    out = rs.union_by_name([a, b]).orderBy("x").collect()
    assert [(r.x, r.z) for r in out] == [(1, None), (2, "y")]


def test_pivot_of_a_duplicate_cell_raises(spark):
    rows = [("d1", "e", 1.0), ("d1", "f", 2.0), ("d2", "e", None)]
    df = spark.createDataFrame(rows, "k string, elementid string, value double")
    got = {r.k: (r.e, r.f) for r in rs.pivot_first(df, ["k"], "elementid", ["e", "f"]).collect()}
    assert got == {"d1": (1.0, 2.0), "d2": (None, None)}
    for again in (("d2", "e", None), ("d1", "f", 2.0)):
        twice = df.unionByName(spark.createDataFrame([again], df.schema))
        with pytest.raises(Exception, match="duplicate entries for elementid"):
            rs.pivot_first(twice, ["k"], "elementid", ["e", "f"]).collect()
