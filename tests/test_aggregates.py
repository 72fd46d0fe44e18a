import datetime as dt


from tidewatch.operators import aggregates as agg
from tidewatch.schemas import THRESHOLDS


def test_weekly_resample_mean_sum_label(spark):
    rows = [(dt.datetime(2024, 1, 7, 13), 1.0, 1.0, "a"), (dt.datetime(2024, 1, 8), 2.0, None, "b"),
            (dt.datetime(2024, 1, 14, 23, 59), 3.0, None, "c"), (dt.datetime(2024, 1, 14), 5.0, None, "d"),
            (dt.datetime(2024, 1, 15), None, None, "e")]
    df = spark.createDataFrame(rows, "ts timestamp, v double, s double, lab string")
    out = {r.ts.date(): r for r in agg.weekly_resample(df, "ts", (), ["v"], ["s"], "lab").collect()}
    assert out[dt.date(2024, 1, 7)].v == 1.0 and out[dt.date(2024, 1, 7)].s == 1.0
    assert out[dt.date(2024, 1, 7)].week is None          # no row stamped exactly on Sunday 00:00
    assert abs(out[dt.date(2024, 1, 14)].v - 10.0 / 3) < 1e-12
    assert out[dt.date(2024, 1, 14)].s == 0.0              # all-null sum -> 0.0
    assert out[dt.date(2024, 1, 14)].week == "d"
    assert out[dt.date(2024, 1, 21)].v is None             # all-null mean -> null


def test_group_mean_keep_vs_drop_null_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", None)], "k string, v double")
    keep = {r.k: r.v for r in agg.group_mean(df, ["k"], ["v"]).collect()}
    drop = {r.k: r.v for r in agg.group_mean(df, ["k"], ["v"], drop_all_null=True).collect()}
    assert keep == {"a": 1.5, "b": None} and drop == {"a": 1.5}


def test_boolean_mean_is_proportion(spark):
    df = spark.createDataFrame([("w", True), ("w", False), ("w", None), ("w", True)], "k string, b boolean")
    r = agg.group_mean(df, ["k"], ["b"], drop_all_null=True).first()
    assert abs(r.b - 2 / 3) < 1e-12


def test_value_counts_and_share(spark):
    df = spark.createDataFrame([(True,), (False,), (None,), (True,)], "haspd boolean")
    out = {r.haspd: (r["count"], r.share_pct) for r in agg.with_share(agg.value_counts(df, "haspd")).collect()}
    assert out == {True: (2, 66.7), False: (1, 33.3)}


def test_roster_metrics_reference_expectations(spark):
    # the reference's only domain assertions (demo metrics test)
    rows = list(zip([3000, 3500, 3200, 3100, 2900, 3300], [50, 52, 51, 48, 47, 53],
                    ["blue", "blue", "red", "green", "blue", "red"]))
    df = spark.createDataFrame(rows, "weight_g int, length_cm int, feather_color string")
    m = agg.roster_metrics(df).first()
    assert m.average_weight == 3167 and m.average_length == 50
    assert m.average_bmi == 12.6 and m.diversity == 0.5
    assert m.average_weight_note == "+Acceptable" and m.average_length_note == "+Acceptable"
    assert m.average_bmi_note == "-Overweight" and m.diversity_note == "-Not diverse"


def test_threshold_alerts(spark):
    rows = [(1, dt.date(2020, 1, 12), 16.2, None), (1, dt.date(2020, 1, 19), 21.0, 0.4)]
    df = spark.createDataFrame(rows, "g int, t date, mean_air_temperature double, avgadultfemalelice double")
    th = {k: THRESHOLDS[k] for k in ("mean_air_temperature", "avgadultfemalelice")}
    out = {r.metric: r for r in agg.threshold_alerts(df, th, ["g"], "t").collect()}
    assert out["mean_air_temperature"].too_high and not out["mean_air_temperature"].missing
    assert not out["avgadultfemalelice"].too_high and out["avgadultfemalelice"].missing
    assert out["avgadultfemalelice"].first_time == dt.date(2020, 1, 12)


def test_null_counts_shape_distinct(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    assert agg.null_counts(df).first().asDict() == {"a": 1, "b": 2}
    assert agg.shape(df).first().asDict() == {"n_rows": 3, "n_cols": 2}
    assert sorted(r.a for r in agg.distinct_values(df, "a").collect() if r.a is not None) == [1, 3]
    assert abs(df.agg(agg.distinct_ratio("a")).first()[0] - 2 / 3) < 1e-12


def test_metric_over_time(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 6), True, 1.0), (dt.date(2020, 1, 6), False, 2.0)],
                               "date date, haspd boolean, lice double")
    assert agg.metric_over_time(df, "haspd").first().haspd == 0.5
    assert agg.metric_over_time(df, "lice").count() == 2
