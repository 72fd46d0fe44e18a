import datetime as dt

from pyspark.sql import functions as F

from tidewatch.operators import aggregates as agg
from tidewatch.operators import dedup as dd
from tidewatch.operators import filters as flt
from tidewatch.operators import reshape as rs
from tidewatch.operators.ordinal import column_positions
from tidewatch.schemas import LICE_COUNTS
from tidewatch.sources import files as fs
from tidewatch.functions import scalar as scl


def test_metric_columns_and_constants(spark):
    df = spark.createDataFrame([(1, "a", 2.0, 3.0)], "localityno int, name string, x double, y double")
    assert rs.metric_columns(df, ["localityno", "name"]) == ["x", "y"]
    out = rs.with_constants(df, week=2, year=2020).first()
    assert (out.week, out.year) == (2, 2020)


def test_lookup_first_and_bulk(spark):
    df = spark.createDataFrame([("A", 2, 7), ("A", 1, 5), ("B", 1, 9)], "name string, w int, no int")
    one = flt.lookup_first(df, "name", "A", ["no"], ["w"]).collect()
    assert [r.no for r in one] == [5]
    assert flt.lookup_first(df, "name", "Z", ["no"], ["w"]).count() == 0
    bulk = {r.name: r.no for r in flt.lookup_first_bulk(df, "name", ["no"], ["w"]).collect()}
    assert bulk == {"A": 5, "B": 9}


def test_date_range_and_year_guard(spark):
    rows = [(dt.datetime(2019, 12, 31),), (dt.datetime(2020, 1, 1),), (dt.datetime(2020, 12, 31, 23),),
            (dt.datetime(2021, 1, 1),)]
    df = spark.createDataFrame(rows, "t timestamp")
    assert flt.date_range(df, "t", year=2020).count() == 2
    # trailing 365 days from 2021-01-01 start on 2020-01-02 (2020 is a leap year)
    assert flt.date_range(df, "t", as_of=dt.date(2021, 1, 1)).count() == 2
    assert flt.year_is_valid(2020) and not flt.year_is_valid(1999)
    years = spark.createDataFrame([(1999,), (2000,), (2022,), (2023,)], "year int")
    assert flt.year_guard(years).count() == 2


def test_row_at_head_and_mark(spark):
    df = spark.createDataFrame([(n,) for n in ["d", "b", "a", "c"]], "name string")
    assert flt.row_at(df, 2, ["name"]).first().name == "c"
    assert [r.name for r in dd.head(df, 2, ["name"]).collect()] == ["a", "b"]
    marked = {r.name: r.size for r in dd.mark_selected(df, 1, ["name"]).collect()}
    assert marked == {"a": 10, "b": 20, "c": 10, "d": 10}


def test_sample_rows(spark):
    df = spark.createDataFrame([(f"n{i}", i) for i in range(20)], "name string, v int")
    s = dd.sample_rows(df, 3, seed=1).collect()
    assert len(s) == 3 and len({r.key for r in s}) == 3 and all(r.record.name == r.key for r in s)


def test_refresh_table_casts_to_schema(spark, scratch):
    df = spark.createDataFrame([("0.4", "1.1", "0.0", "7.6", "A", None, "2020-01-13", "2", "2020")],
                               ", ".join(f"{f.name} string" for f in LICE_COUNTS.fields))
    out = fs.refresh_table(df.withColumn("specieslist", F.array(F.lit("Laks"))), LICE_COUNTS, f"{scratch}/lice")
    r = spark.read.parquet(f"{scratch}/lice").first()
    assert r.avgadultfemalelice == 0.4 and r.week == 2 and r.year_week == dt.date(2020, 1, 13)
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in LICE_COUNTS]


def test_region_and_bmi_and_round(spark):
    df = spark.createDataFrame([(63.80,), (63.81,), (68.85,), (68.86,), (None,)], "lat double")
    assert [r[0] for r in df.select(scl.region_of_latitude("lat")).collect()] == \
        ["South", "Middle", "Middle", "North", "NaN"]
    v = spark.createDataFrame([(2.5, 3000, 50)], "x double, g int, cm int")
    r = v.select(scl.round_half_even("x").alias("e"), F.round("x").alias("u"),
                 scl.body_mass_index("g", "cm").alias("bmi")).first()
    assert (r.e, r.u, round(r.bmi, 6)) == (2.0, 3.0, 12.0)


def test_profile_counts_on_the_way(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (3, None)], "k int, v string")
    profile = agg.Profile()
    first = profile.step(df, "all", ["v", "k"])
    second = profile.step(first.where("k > 1"), "some")
    assert second.count() == 2
    got = [tuple(r) for r in profile.table(spark).collect()]
    assert got == [("all", 3, 2, "v", 2), ("all", 3, 2, "k", 0), ("some", 2, 2, None, None)]


def test_column_positions(spark):
    df = spark.createDataFrame([(1, None, 2.0), (None, None, 3.0)], "a int, `b c` string, d double")
    assert [tuple(r) for r in column_positions(df).collect()] == [(0, "a", 1), (1, "b c", 0), (2, "d", 2)]
