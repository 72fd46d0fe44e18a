import datetime as dt


from tidewatch.functions import calendar as cal


def _one(spark, expr, schema, rows):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_sunday_first_and_monday_first_weeks(spark):
    rows = [(2020, 1), (2020, 52), (2018, 1), (2023, 52)]
    df = spark.createDataFrame(rows, "year int, week int")
    got = df.select(cal.monday_sunday_first("year", "week").alias("u"),
                    cal.monday_monday_first("year", "week").alias("w")).collect()
    assert got[0].u == dt.date(2020, 1, 6)
    assert got[1].u == dt.date(2020, 12, 28)
    assert got[2].u == dt.date(2018, 1, 8) and got[2].w == dt.date(2018, 1, 1)
    assert got[3].u == dt.date(2023, 12, 25) and got[3].w == dt.date(2023, 12, 25)


def test_sunday_first_matches_strptime_over_many_years(spark):
    rows = [(y, w) for y in range(1995, 2031) for w in (1, 2, 26, 52)]
    df = spark.createDataFrame(rows, "year int, week int")
    got = df.select("year", "week", cal.monday_sunday_first("year", "week").alias("u"),
                    cal.monday_monday_first("year", "week").alias("w")).collect()
    for r in got:
        assert r.u == dt.datetime.strptime(f"{r.year}-{r.week}-1", "%Y-%U-%w").date()
        assert r.w == dt.datetime.strptime(f"{r.year}-{r.week}-1", "%Y-%W-%w").date()


def test_iso_week_and_year(spark):
    df = spark.createDataFrame([(dt.datetime(2021, 1, 3, 12),)], "ts timestamp")
    r = df.select(cal.iso_week("ts").alias("w"), cal.iso_year("ts").alias("y"),
                  cal.year_week_label(cal.iso_year("ts"), cal.iso_week("ts")).alias("l")).first()
    assert (r.w, r.y, r.l) == (53, 2020, "2020_53")


def test_week_ending_sunday_keeps_whole_sunday(spark):
    rows = [(dt.datetime(2024, 1, 7, 13),), (dt.datetime(2024, 1, 8, 0),), (dt.datetime(2024, 1, 14, 23, 59),)]
    got = _one(spark, cal.week_ending_sunday("ts"), "ts timestamp", rows)
    assert got == [dt.date(2024, 1, 7), dt.date(2024, 1, 14), dt.date(2024, 1, 14)]


def test_trailing_spine(spark):
    df = spark.createDataFrame([(dt.date(2023, 3, 1),), (dt.date(2023, 12, 31),)], "d date")
    got = df.select(cal.trailing_weeks("d").alias("s")).collect()
    first = [(x.year, x.week) for x in got[0].s]
    # day 60 -> w = 9: previous-year weeks 10..52 then 1..9
    assert first[0] == (2022, 10) and first[42] == (2022, 52) and first[43] == (2023, 1) and first[-1] == (2023, 9)
    assert len(first) == 52
    last = [(x.year, x.week) for x in got[1].s]
    assert len(last) == 53 and last[0] == (2023, 1) and last[-1] == (2023, 53)


def test_weeks_of_the_year(spark):
    rows = cal.weeks_of_the_year(spark, 2020).collect()
    assert [r.week for r in rows] == list(range(1, 53)) and {r.year for r in rows} == {2020}
