"""Registered queries: each reads the supplied tables at ``sf_dir`` and returns a DataFrame.

Names map to SURVEY §2 operator IDs (see ``COVERAGE``). Floating outputs are
rounded to 6 decimals and timestamps cast to dates so the DuckDB oracle in
:mod:`tidewatch.plans.oracle` can compare values exactly.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import calendar as cal
from ..functions import scalar as scl
from ..operators import aggregates as agg
from ..operators import arimax as ax
from ..operators import dedup as dd
from ..operators import diagnostics as dg
from ..operators import filters as flt
from ..operators import joins as jn
from ..operators import reshape as rs
from ..operators import robust as rb
from ..operators.ordinal import column_positions
from ..operators import series as ser
from ..schemas import COMBINED_METRICS, LICE_COLUMNS, LICE_COUNTS
from ..schemas import SUMMARY_DOC, THRESHOLDS
from ..session import cut_lineage, ensure_checkpoint_dir, stored
from ..sources import commit_log
from ..sources import files as fs
from ..sources import supplied as sup
from . import pipelines as pl

BY_MUN = ["municipalityno"]
Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
COVERAGE: dict[str, list[str]] = {}


def register(name: str, ids: list[str]):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        COVERAGE[name] = ids
        return fn
    return deco


def finish(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round doubles, timestamps -> dates (comparison-friendly, same on the SQL side).

    Doubles are rounded as decimals, so halves go up whatever the last bit of the double.
    """
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c.try_cast("decimal(38,10)"), digits).cast("double")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = c.cast("date")
        cols.append(c.alias(f.name))
    return df.select(*cols)


# ---------------------------------------------------------------------------
# shared building blocks
# ---------------------------------------------------------------------------

def lice_table(spark: SparkSession, d: str) -> DataFrame:
    """E2 output on the supplied tables: municipality x year x week 1..52 with the reports."""
    return pl.lice_counts(sup.lice_reports(spark, d), by=("municipalityno",), descriptors=("localityname",))


def combined_table(spark: SparkSession, d: str, mode: str = "script") -> DataFrame:
    return pl.combine(sup.observations(spark, d), lice_table(spark, d), by=("municipalityno",), mode=mode)


# ---------------------------------------------------------------------------
# E3 flagship
# ---------------------------------------------------------------------------

@register("combine_weekly", ["E3", "P3", "C5", "C6", "C8", "C9", "A1", "D3", "A6", "A7", "A8", "J3", "J6",
                             "R7", "R9", "J1", "P5", "P6", "R11", "E2", "J4", "C1", "C3"])
def q_combine_weekly(spark: SparkSession, d: str) -> DataFrame:
    return finish(combined_table(spark, d, "script"))


# ---------------------------------------------------------------------------
# calendar (C1-C9, C14, U3)
# ---------------------------------------------------------------------------


@register("calendar_labels", ["C3", "C4", "C5", "C6", "C7", "C8", "C9", "C14"])
def q_calendar_labels(spark: SparkSession, d: str) -> DataFrame:
    o = sup.table(spark, d, "orders")
    days = o.select(cal.to_utc_timestamp_col("o_orderdate").alias("ts")).distinct()
    out = days.select(
        F.col("ts").cast("date").alias("day"),
        cal.iso_year("ts").alias("iso_year"), cal.iso_week("ts").alias("iso_week"),
        cal.year_week_label(cal.iso_year("ts"), cal.iso_week("ts"), "_").alias("label_underscore"),
        cal.year_week_label(F.year("ts"), cal.iso_week("ts"), "-").alias("label_dash"),
        cal.week_ending_sunday("ts").alias("week_end"),
        cal.monday_sunday_first(F.year("ts"), cal.iso_week("ts")).alias("monday_u"),
        cal.monday_monday_first(F.year("ts"), cal.iso_week("ts")).alias("monday_w"),
        scl.as_text(F.dayofyear("ts")).alias("doy_text"))
    return finish(out)


@register("week_spine", ["C1", "C2", "U3"])
def q_week_spine(spark: SparkSession, d: str) -> DataFrame:
    """C1 spine for every report year plus the C2 trailing spine as of each year's last order day."""
    o = sup.table(spark, d, "orders")
    ts = cal.to_utc_timestamp_col("o_orderdate")
    last = o.groupBy(F.year(ts).alias("as_of_year")).agg(F.max(ts).cast("date").alias("as_of"))
    trailing = last.select("as_of", F.posexplode(cal.trailing_weeks("as_of")).alias("pos", "wk")) \
        .select(F.lit("trailing").alias("kind"), "as_of", "pos", F.col("wk.year").alias("year"),
                F.col("wk.week").alias("week"))
    years = last.select(F.col("as_of_year").alias("year"), "as_of")
    calendar = cal.weeks_of_years(years.select("year")).join(years, "year") \
        .select(F.lit("calendar").alias("kind"), "as_of", (F.col("week") - 1).alias("pos"), "year", "week")
    return finish(trailing.unionByName(calendar))


# ---------------------------------------------------------------------------
# landed documents
# ---------------------------------------------------------------------------

@register("summary_flatten", ["S1", "P1", "U1", "P4", "C3", "E1", "P11"])
def q_summary_flatten(spark: SparkSession, d: str) -> DataFrame:
    """Weekly summary documents rebuilt from the reports (pages of at most 1000 localities),
    landed as JSON files, read with the declared schema and flattened back (E1)."""
    fish = sup.fish_table(spark, d)
    camel = {f.name.lower(): f.name for f in SUMMARY_DOC["localities"].dataType.elementType.fields}
    loc_struct = F.struct(*[F.col(k).alias(v) for k, v in camel.items()])
    docs = (fish.groupBy("year", "week", F.floor(F.col("localityweekid") / 1000).alias("page"))
            .agg(F.collect_list(loc_struct).alias("localities")))
    path = fs.land(rs.json_text(docs, ["year", "week", "localities"]), ensure_checkpoint_dir(spark))
    return finish(pl.year_summary(fs.read_summaries(spark, path, multiline=False)))


#: summary documents by page, as they are landed for the quarantine
PAGED_DOC = T.StructType([SUMMARY_DOC["year"], SUMMARY_DOC["week"], T.StructField("page", T.LongType()), T.StructField(
    "localities", T.ArrayType(T.StructType([T.StructField("localityNo", T.LongType()), T.StructField("localityWeekId", T.LongType())])))])


@register("documents_quarantine", ["S1", "S2", "S3"])
def q_documents_quarantine(spark: SparkSession, d: str) -> DataFrame:
    """Summary documents fetched again and again: a second fetch has fewer localities, a third is cut off, a fourth lacks its
    year, a fifth has a word for it. What can't be read is counted by its reason; of the rest the newest
    of each page is kept and counted by week."""
    fish = sup.fish_table(spark, d)
    page = F.floor(F.col("localityweekid") / 1000).alias("page")
    place = F.struct(F.col("localityno").alias("localityNo"), F.col("localityweekid").alias("localityWeekId"))
    docs = fish.groupBy("year", "week", page).agg(F.collect_list(place).alias("localities"))
    odd = F.filter("localities", lambda x: x["localityWeekId"] % 2 == 1)
    fields = ["week", "page", "localities"]
    whole = F.to_json(F.struct("year", *fields))
    fetches = [(F.lit(True), whole), (F.col("week") % 5 == 0, F.to_json(F.struct("year", "week", "page", odd.alias("localities")))),
               (F.col("week") % 7 == 0, F.substring(whole, 1, 30)), (F.col("week") % 11 == 0, F.to_json(F.struct(*fields))),
               (F.col("week") % 13 == 0, F.to_json(F.struct(F.lit("soon").alias("year"), *fields)))]
    every = F.explode(F.array(*[F.when(when, F.struct(F.lit(k).alias("fetch"), text.alias("json"))) for k, (when, text) in enumerate(fetches)])).alias("_f")
    path = fs.land(docs.select(every).where("_f is not null").select("_f.*"), ensure_checkpoint_dir(spark), ["fetch"])
    good, rejected = fs.split_documents(spark, path, PAGED_DOC, ["year", "week"])
    kept = fs.newest_documents(good, ["year", "week", "page"], ["fetch"])
    by_week = kept.groupBy("year", "week").agg(F.count(F.lit(1)).alias("documents"), F.sum(F.size("localities")).alias("localities"))
    by_reason = rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("documents"))
    return by_week.select(F.lit("kept").alias("reason"), "year", "week", "documents", "localities").unionByName(
        by_reason.select("reason", "documents"), allowMissingColumns=True)


@register("detail_extract", ["S2", "P2", "P4"])
def q_detail_extract(spark: SparkSession, d: str) -> DataFrame:
    rep = sup.lice_reports(spark, d)
    docs = rep.select(F.to_json(F.struct(
        F.col("municipalityno").cast("long").alias("localityNo"), "year", "week",
        F.col("localityname").alias("localityName"),
        F.struct(F.col("avgadultfemalelice").alias("avgAdultFemaleLice"),
                 F.col("avgmobilelice").alias("avgMobileLice"),
                 F.col("avgstationarylice").alias("avgStationaryLice"),
                 F.col("seatemperature").alias("seaTemperature")).alias("localityWeek"),
        F.struct(F.col("specieslist").alias("speciesList")).alias("aquaCultureRegister"))).alias("json"))
    parsed = fs.read_details(spark, fs.land(docs, ensure_checkpoint_dir(spark)), multiline=False)
    flat = rs.lower_columns(rs.extract_detail(parsed, ["localityNo", "year", "week"]))
    return finish(flat.withColumn("specieslist", scl.join_text("specieslist")))


#: pages of a station's day in the landed observation documents
OBSERVATION_PAGES = 4


@register("observations_flatten", ["S3", "P3", "U2", "C8", "P6"])
def q_observations_flatten(spark: SparkSession, d: str) -> DataFrame:
    """Observation documents rebuilt from the observations, landed as JSON files in a folder for each
    municipality, read and flattened (S3/P3). A document has one page of a station's day: a day's
    readings are split by a hash, so that documents stay small however dense a station reports. The files are compressed."""
    rows = sup.readings(spark, d)
    page = F.pmod(F.xxhash64(*sup.READING), F.lit(OBSERVATION_PAGES))
    # a reading goes through the shuffle as one narrow row; its observations are spelled out behind it
    station_day = ["municipalityno", "l_suppkey", "l_shipdate", "_page"]
    per_day = rows.withColumn("_page", page).repartition(*station_day).groupBy(*station_day).agg(
        F.collect_list(F.struct(*sup.READING)).alias("_readings"))
    spelled = F.transform("_readings", lambda r: F.transform(sup.elements_of(r.getField), lambda e: F.struct(
        e["elementid"].alias("elementId"), e["value"].alias("value"), e["unit"].alias("unit"),
        sup.time_offset_of(r["l_linenumber"]).alias("timeOffset"))))
    per_day = per_day.select("municipalityno", sup.station_of(F.col("l_suppkey")).alias("sourceid"),
                             cal.to_utc_timestamp_col("l_shipdate").alias("referencetime"), F.flatten(spelled).alias("observations"))
    stamp = F.date_format("referencetime", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    data = F.array(F.struct(F.col("sourceid").alias("sourceId"), stamp.alias("referenceTime"), "observations"))
    docs = per_day.select("municipalityno", F.to_json(F.struct(data.alias("data"))).alias("json"))
    parsed = fs.read_observations(spark, fs.land(docs, ensure_checkpoint_dir(spark), ["municipalityno"], "gzip"), multiline=False)
    return finish(rs.flatten_observations(parsed, ["municipalityno"]))


@register("lice_counts", ["E2", "J4", "C1", "C3", "P2", "P4", "P8"])
def q_lice_counts(spark: SparkSession, d: str) -> DataFrame:
    lice = rs.drop_all_null_columns(lice_table(spark, d))
    return finish(lice.withColumn("specieslist", scl.join_text("specieslist")))


@register("lice_csv", ["S5", "S6", "S9", "P8", "P9"])
def q_lice_csv(spark: SparkSession, d: str) -> DataFrame:
    """The lice table with a remark column that nobody filled: refreshed as a typed table, the empty column dropped (P8),
    written as CSV and read back, lists from their text; one row per week and metric column (P9)."""
    schema = T.StructType([T.StructField("municipalityno", T.IntegerType()), *LICE_COUNTS.fields, T.StructField("remark", T.StringType())])
    lice = lice_table(spark, d).withColumn("remark", F.lit(None).cast("string"))
    typed = rs.drop_all_null_columns(fs.refresh_table(lice, schema, _scratch(spark, "lice")))
    path = _scratch(spark, "csv")
    fs.write_csv(typed, path)
    flat = T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.ArrayType) else f.dataType)
                         for f in typed.schema.fields])
    back = fs.read_csv(spark, path, flat).withColumn("specieslist", scl.join_text(fs.parse_list_text(F.col("specieslist"))))
    metrics = rs.metric_columns(back, ["municipalityno", "localityname", "specieslist", "year_week", "week", "year"])
    rows = F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in metrics]))
    return finish(back.select("municipalityno", "localityname", "year_week", "specieslist", rows))


def _scratch(spark: SparkSession, kind: str) -> str:
    """A new folder in the session's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"


@register("lice_null_counts", ["A14"])
def q_lice_null_counts(spark: SparkSession, d: str) -> DataFrame:
    lice = lice_table(spark, d)
    return agg.null_counts(lice, ["avgadultfemalelice", "avgmobilelice", "avgstationarylice", "seatemperature",
                                  "localityname", "specieslist", "year_week", "week", "year"])


# ---------------------------------------------------------------------------
# weekly national / regional series
# ---------------------------------------------------------------------------

def _labelled_fish(spark: SparkSession, d: str) -> DataFrame:
    fish = sup.fish_table(spark, d)
    return fish.withColumn("year_week", cal.year_week_label("year", "week", "-"))


@register("weekly_lice_mean", ["A3", "C7", "C4", "V6"])
def q_weekly_lice_mean(spark: SparkSession, d: str) -> DataFrame:
    fish = _labelled_fish(spark, d)
    m = agg.group_mean(fish, ["year_week", "year", "week"], ["avgadultfemalelice"],
                       {"avgadultfemalelice": "avg_adult_female_lice"}, exact=True)
    return finish(m.select("year_week", "avg_adult_female_lice",
                           cal.monday_monday_first("year", "week").alias("date")))


@register("weekly_disease_share", ["A4", "C4", "V6"])
def q_weekly_disease_share(spark: SparkSession, d: str) -> DataFrame:
    fish = _labelled_fish(spark, d)
    m = agg.group_mean(fish, ["year_week", "year", "week"], ["haspd", "hasila"], drop_all_null=True)
    return finish(m.select("year_week", "haspd", "hasila", cal.monday_monday_first("year", "week").alias("date")))


@register("region_weekly_lice", ["A5", "C10", "C4", "V6"])
def q_region_weekly_lice(spark: SparkSession, d: str) -> DataFrame:
    fish = _labelled_fish(spark, d).withColumn("region", scl.region_of_latitude("lat"))
    m = agg.group_mean(fish, ["region", "year_week", "year", "week"], ["avgadultfemalelice"], drop_all_null=True,
                       exact=True)
    return finish(m.select("region", "year_week", "avgadultfemalelice",
                           cal.monday_monday_first("year", "week").alias("date")))


@register("lice_series_union", ["U1", "P11", "V6"])
def q_lice_series_union(spark: SparkSession, d: str) -> DataFrame:
    """National and regional weekly series in one table: scope is constant in each part, region missing in the first."""
    fish = _labelled_fish(spark, d)
    national = agg.group_mean(fish, ["year_week"], ["avgadultfemalelice"], exact=True)
    regional = agg.group_mean(fish.withColumn("region", scl.region_of_latitude("lat")), ["region", "year_week"],
                              ["avgadultfemalelice"], drop_all_null=True, exact=True)
    return finish(rs.union_by_name([rs.with_constants(national, scope="national"), rs.with_constants(regional, scope="regional")]))


# ---------------------------------------------------------------------------
# dashboard datasets
# ---------------------------------------------------------------------------

#: row of the locality list that the selection queries click
SELECTED_ROW = 3


@register("metric_over_time_bool", ["A9", "V3"])
def q_metric_over_time_bool(spark: SparkSession, d: str) -> DataFrame:
    return finish(agg.metric_over_time(sup.fish_table(spark, d), "haspd"))


@register("metric_over_time_numeric", ["A9", "V3", "W10"])
def q_metric_over_time_numeric(spark: SparkSession, d: str) -> DataFrame:
    return finish(agg.metric_over_time(sup.fish_table(spark, d), "avgadultfemalelice"))


@register("disease_share", ["A10", "A11", "R1", "V2"])
def q_disease_share(spark: SparkSession, d: str) -> DataFrame:
    fish = flt.select_name(sup.fish_table(spark, d), flt.ALL)
    return finish(agg.with_share(agg.value_counts(fish, "haspd", ordered=False)))


@register("disease_share_by_locality", ["A10", "A11", "R1", "V2"])
def q_disease_share_by_locality(spark: SparkSession, d: str) -> DataFrame:
    fish = sup.fish_table(spark, d)
    return finish(agg.with_share(agg.value_counts(fish, "haspd", by=["name"], ordered=False), by=["name"]))


@register("locality_selection", ["R12", "R1"])
def q_locality_selection(spark: SparkSession, d: str) -> DataFrame:
    """A click on a row of the locality list (R12), then that locality's reports by its name."""
    fish = sup.fish_table(spark, d)
    names = fish.select("name").distinct()
    name = flt.row_at(names, SELECTED_ROW, ["name"]).first()[0]
    return finish(flt.select_name(fish, name).select("name", "localityweekid", "year", "week", "avgadultfemalelice", "haspd"))


@register("metric_series", ["V4", "W10"])
def q_metric_series(spark: SparkSession, d: str) -> DataFrame:
    """Chart rows of every metric of the weekly panel: time, value and the metric's threshold line."""
    comb = combined_table(spark, d)
    rows = F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value"), F.lit(float(t)).alias("threshold"))
                              for m, t in THRESHOLDS.items()]))
    return finish(comb.select("municipalityno", "referencetime", rows).where(F.col("value").isNotNull()))


@register("locality_points", ["D2", "D7", "P10", "R12", "D4", "V1", "P6"])
def q_locality_points(spark: SparkSession, d: str) -> DataFrame:
    fish = sup.fish_table(spark, d)
    first = dd.keep_first(fish, ["name"], ["year", "week", "localityweekid"], ["lat", "lon", "haspd", "localityno"])
    marked = dd.mark_selected(first.select("name", "lat", "lon"), selected=3, order_by=["name"])
    return finish(marked.withColumn("key", F.col("ordinal").cast("string")))


@register("first_report_per_locality", ["D1", "R2", "R3"])
def q_first_report_per_locality(spark: SparkSession, d: str) -> DataFrame:
    fish = sup.fish_table(spark, d)
    return finish(flt.lookup_first_bulk(fish, "localityno", ["name", "lat", "lon", "localityweekid"],
                                        ["localityweekid"]))


@register("combined_alerts", ["A12", "A13", "W9", "W10", "V4"])
def q_combined_alerts(spark: SparkSession, d: str) -> DataFrame:
    comb = combined_table(spark, d)
    return finish(agg.threshold_alerts(comb, THRESHOLDS, by=["municipalityno"], ts_col="referencetime"))


@register("fish_table_shape", ["A20"])
def q_fish_table_shape(spark: SparkSession, d: str) -> DataFrame:
    return agg.shape(sup.fish_table(spark, d))


@register("panel_profile", ["A20", "A14"])
def q_panel_profile(spark: SparkSession, d: str) -> DataFrame:
    """Rows, columns and nulls of the weekly panel's steps, counted by the one job that writes the panel."""
    profile = agg.Profile()
    lice = profile.step(lice_table(spark, d), "lice", [*LICE_COLUMNS, "seatemperature"])
    weekly = profile.step(pl.weekly_weather(sup.observations(spark, d), BY_MUN), "weekly", ["week"])
    panel = profile.step(pl.with_lice(weekly, lice, BY_MUN), "panel", [*LICE_COLUMNS, "localityname"])
    stored(panel)
    return profile.table(spark)


@register("column_positions", ["P10"])
def q_column_positions(spark: SparkSession, d: str) -> DataFrame:
    return column_positions(sup.fish_table(spark, d))


@register("reports_in_years", ["R8"])
def q_reports_in_years(spark: SparkSession, d: str) -> DataFrame:
    """Weeks with a lice count in the years that requests are answered for (2000 to 2022), per year."""
    return flt.year_guard(lice_table(spark, d)).groupBy("year").agg(F.count("avgadultfemalelice").alias("n_weeks"))


@register("element_catalog", ["A19"])
def q_element_catalog(spark: SparkSession, d: str) -> DataFrame:
    return agg.distinct_values(sup.observations(spark, d), "elementid")


@register("element_series_year", ["R5", "R6", "R8"])
def q_element_series_year(spark: SparkSession, d: str) -> DataFrame:
    """Daily precipitation per station for one calendar year (the year is the request parameter)."""
    year = 1997
    if not flt.year_is_valid(year, lo=1990, hi=2022):
        raise ValueError(f"no observations are requested for {year}")
    obs = flt.date_range(sup.observations(spark, d), "referencetime", year=year)
    return finish(flt.element_series(obs, "sum(precipitation_amount P1D)", keys=["sourceid"]))


# ---------------------------------------------------------------------------
# demo roster
# ---------------------------------------------------------------------------

ROSTER_MIN = {"length_cm": 25, "weight_g": 300}


@register("roster_metrics", ["R4", "A15", "A16", "C11", "C12", "C13", "V5"])
def q_roster_metrics(spark: SparkSession, d: str) -> DataFrame:
    return finish(agg.roster_metrics(flt.at_least(sup.roster(spark, d), ROSTER_MIN)))


@register("roster_role_counts", ["A17", "V5"])
def q_roster_role_counts(spark: SparkSession, d: str) -> DataFrame:
    return agg.count_by(flt.at_least(sup.roster(spark, d), ROSTER_MIN), "role")


@register("roster_role_means", ["A18", "V5"])
def q_roster_role_means(spark: SparkSession, d: str) -> DataFrame:
    return finish(agg.means_by(flt.at_least(sup.roster(spark, d), ROSTER_MIN), "role", ["length_cm", "weight_g"]))


# ---------------------------------------------------------------------------
# keyed upsert
# ---------------------------------------------------------------------------

@register("upsert_reports", ["S8", "S7"])
def q_upsert_reports(spark: SparkSession, d: str) -> DataFrame:
    """Open orders are re-reported in a second batch with a corrected lice count; per key the
    newer batch wins and keeps its whole row. The table is committed, the batch is merged into the buckets that
    it touches, and the highest version is read back."""
    fish = sup.fish_table(spark, d)
    existing = fish.select("localityweekid", "localityno", "year", "week", "avgadultfemalelice")
    batch = fish.where(~F.col("isfallow") & F.col("hasila")) \
        .select("localityweekid", "localityno", "year", "week",
                (F.col("avgadultfemalelice") + F.lit(0.01)).alias("avgadultfemalelice"))
    root = _scratch(spark, "reports")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    commit_log.merge(existing, root, ["localityweekid"], buckets)
    commit_log.merge(batch, root, ["localityweekid"], buckets)
    return finish(commit_log.read(spark, root))


# ---------------------------------------------------------------------------
# ordered series (W1-W8) on the weekly lice table / weekly panel, per municipality
# ---------------------------------------------------------------------------


LAGS = [0, 1, 2, 3, 4]


@register("lagged_correlation", ["W1", "W3", "R10", "P7"])
def q_lagged_correlation(spark: SparkSession, d: str) -> DataFrame:
    lice = rs.drop_columns(lice_table(spark, d), ["localityname", "specieslist", "week", "year"])
    return finish(ser.lagged_correlation(lice, "avgadultfemalelice", "seatemperature", LAGS, BY_MUN, ["year_week"]))


@register("sliding_correlation", ["W4", "W5"])
def q_sliding_correlation(spark: SparkSession, d: str) -> DataFrame:
    lice = lice_table(spark, d).select("municipalityno", "year_week", "seatemperature", "avgadultfemalelice")
    swc = ser.sliding_correlation(lice, "seatemperature", "avgadultfemalelice", 5, BY_MUN, ["year_week"])
    framed = ser.highlight_frame(swc, center=10, window=5, by=BY_MUN, order_by=["year_week"])
    return finish(framed.select("municipalityno", "year_week", "swc", "in_frame"))


@register("densify_lag_backfill", ["W6", "W2", "P7", "C8", "E5"])
def q_densify_lag_backfill(spark: SparkSession, d: str) -> DataFrame:
    comb = rs.drop_columns(combined_table(spark, d), ["localityname"])
    dense = ser.densify_weekly(comb, "referencetime", BY_MUN)
    return finish(ser.lag_backfill(dense, COMBINED_METRICS, BY_MUN, ["referencetime"]))


@register("gaussian_smoothing", ["W7", "W10", "E4"])
def q_gaussian_smoothing(spark: SparkSession, d: str) -> DataFrame:
    lice = lice_table(spark, d).select("municipalityno", "year_week", *LICE_COLUMNS)
    sm = ser.gaussian_smooth(lice, LICE_COLUMNS, BY_MUN, ["year_week"], sigma=1.0)
    return finish(sm.select("municipalityno", "year_week", *[f"{c}_smooth" for c in LICE_COLUMNS]))


@register("lice_proportions", ["W8"])
def q_lice_proportions(spark: SparkSession, d: str) -> DataFrame:
    lice = lice_table(spark, d).select("municipalityno", "year_week", *LICE_COLUMNS)
    return finish(ser.lice_proportions(lice, LICE_COLUMNS).drop(*LICE_COLUMNS))


@register("top_precipitation_weeks", ["D5", "D4"])
def q_top_precipitation_weeks(spark: SparkSession, d: str) -> DataFrame:
    """Top-10 report: the wettest weeks of the weekly panel (the limit is the feature)."""
    comb = combined_table(spark, d).select("municipalityno", "referencetime", "sum_precipitation_amount")
    return finish(dd.head(comb, 10, [F.desc("sum_precipitation_amount"), "municipalityno", "referencetime"]))


@register("sample_members", ["D6"])
def q_sample_members(spark: SparkSession, d: str) -> DataFrame:
    s = dd.sample_rows(sup.roster(spark, d), 3, seed=7, key="name")
    return s.select("key", F.to_json("record").alias("record"))


# ---------------------------------------------------------------------------
# joins: k nearest stations
# ---------------------------------------------------------------------------

@register("combine_nearest", ["E3", "J5", "R6", "R7", "A1", "D3", "A6", "A7", "A8", "J3", "R9", "J1", "R11"])
def q_combine_nearest(spark: SparkSession, d: str) -> DataFrame:
    """Weekly panel of every locality from its five nearest stations, for the 365 days up to the last observation."""
    obs = sup.observations(spark, d)
    last = sup.table(spark, d, "lineitem").agg(F.max("l_shipdate").cast("date")).first()[0]
    panel = pl.combine_nearest(obs, lice_table(spark, d), sup.localities(spark, d), sup.stations(spark, d), as_of=last)
    return finish(panel)


@register("nearest_stations", ["J5", "S4"])
def q_nearest_stations(spark: SparkSession, d: str) -> DataFrame:
    near = jn.nearest_stations(sup.localities(spark, d), sup.stations(spark, d), k=5)
    return finish(near)


# ---------------------------------------------------------------------------
# process control
# ---------------------------------------------------------------------------

def _chartable(spark: SparkSession, d: str) -> DataFrame:
    """Complete lice rows of all municipalities."""
    return lice_table(spark, d).select("municipalityno", "year_week", *LICE_COLUMNS).dropna(subset=LICE_COLUMNS)


# Columns of the chart, in its order.
CHART_COLUMNS = ["avgstationarylice", "avgmobilelice", "avgadultfemalelice"]


@register("hotelling_t2", ["M2"])
def q_hotelling_t2(spark: SparkSession, d: str) -> DataFrame:
    t2 = rb.hotelling_t2(cut_lineage(_chartable(spark, d)), CHART_COLUMNS, BY_MUN, alpha=0.0027)
    return finish(t2.select("municipalityno", "year_week", "t2", "f_stat"))


@register("control_chart", ["M1", "M2", "M3", "E4"])
def q_control_chart(spark: SparkSession, d: str) -> DataFrame:
    data = cut_lineage(_chartable(spark, d))
    center = rb.min_cov_det(data, CHART_COLUMNS, BY_MUN, n_trials=30, n_best=10, seed=0)
    chart = rb.hotelling_t2(data, CHART_COLUMNS, BY_MUN, center=center, n=None, alpha=0.0027)
    return finish(chart.select("municipalityno", "year_week", "t2", "f_stat", "p_value", "t2_limit",
                               "t2_exceeds", "p_exceeds"))


@register("classical_chart", ["M2", "M3"])
def q_classical_chart(spark: SparkSession, d: str) -> DataFrame:
    """Control chart around the classical estimates: T², F, its tail, the limit and both flags."""
    chart = rb.hotelling_t2(cut_lineage(_chartable(spark, d)), CHART_COLUMNS, BY_MUN, alpha=0.0027)
    return finish(chart.select("municipalityno", "year_week", "t2", "f_stat", "p_value", "t2_limit", "t2_exceeds", "p_exceeds"))


@register("robust_quarters", ["M1"])
def q_robust_quarters(spark: SparkSession, d: str) -> DataFrame:
    """M1 per municipality and quarter: keys so small that all subsets are searched, so the estimate is the exact one."""
    cols = ["avgadultfemalelice", "seatemperature"]
    rows = lice_table(spark, d).select("municipalityno", "year", F.expr("(week - 1) div 13").cast("int").alias("quarter"), *cols)
    found = rb.min_cov_det(rows, cols, ["municipalityno", "year", "quarter"])
    names = {"n_used": "_n", "m0": "_m0", "m1": "_m1", "c00": "_c0_0", "c01": "_c0_1", "c11": "_c1_1"}
    # which rows an exact fit takes is open, as is the place of the raw estimate if subsets tie
    return finish(found.select("municipalityno", "year", "quarter", "n_rows", "h", F.exp("raw_logdet").alias("raw_det"), "status",
                               *[F.when(F.col("status") == rb.ESTIMATED, F.col(c)).alias(name) for name, c in names.items()]))


@register("robust_support", ["M1"])
def q_robust_support(spark: SparkSession, d: str) -> DataFrame:
    """M1 invariants per municipality: rows, h, the support's size, and whether the search converged."""
    center = rb.min_cov_det(cut_lineage(_chartable(spark, d)), CHART_COLUMNS, BY_MUN, n_trials=30, n_best=10, seed=0)
    return center.select("municipalityno", "n_rows", "h", F.col("n_support").alias("support"), "converged")


# ---------------------------------------------------------------------------
# forecasting study (M4-M7, E5)
# ---------------------------------------------------------------------------


# Regressors of the study's model and of the dashboard's.
M4_REGRESSORS = ["avgadultfemalelice", "avgmobilelice", "avgstationarylice", "mean_air_temperature",
                 "mean_relative_humidity", "mean_wind_speed", "sum_precipitation_amount"]
M5_REGRESSORS = M4_REGRESSORS + [f"{c}_lag" for c in M4_REGRESSORS]
DASHBOARD_REGRESSORS = ["seatemperature", "mean_air_temperature", "mean_relative_humidity", "mean_wind_speed",
                        "sum_precipitation_amount"]


def weekly_panel_dense(spark: SparkSession, d: str) -> DataFrame:
    """E5 input: weekly panel per municipality, densified to every Sunday, lag-1 back-filled columns."""
    comb = rs.drop_columns(combined_table(spark, d), ["localityname"])
    dense = ser.densify_weekly(comb, "referencetime", BY_MUN)
    return ser.lag_backfill(dense, COMBINED_METRICS, BY_MUN, ["referencetime"])


@register("arimax_fit", ["M4", "M7", "E5"])
def q_arimax_fit(spark: SparkSession, d: str) -> DataFrame:
    panel = cut_lineage(weekly_panel_dense(spark, d))
    coefs, _ = ax.arimax_fit(panel, "seatemperature", M4_REGRESSORS, BY_MUN, ["referencetime"])
    return finish(coefs)


@register("arimax_select_refit", ["M5", "M6", "M7", "E5"])
def q_arimax_select_refit(spark: SparkSession, d: str) -> DataFrame:
    """14-regressor model, regressors with p > 0.4 removed per municipality, refit; AIC of both."""
    panel = cut_lineage(weekly_panel_dense(spark, d))  # materialised once, read by both fits
    coefs, fit_full = ax.arimax_fit(panel, "seatemperature", M5_REGRESSORS, BY_MUN, ["referencetime"])
    active = ax.select_by_pvalue(coefs, M5_REGRESSORS, BY_MUN, 0.4)
    _, fit_reduced = ax.arimax_fit(panel, "seatemperature", M5_REGRESSORS, BY_MUN, ["referencetime"], active=active)
    both = fit_full.withColumn("model", F.lit("full")).unionByName(fit_reduced.withColumn("model", F.lit("reduced")))
    return finish(both)


@register("arimax_equations", ["M4"])
def q_arimax_equations(spark: SparkSession, d: str) -> DataFrame:
    """Check of the M4 fit: rows used, terms, and the normal equations' left-over, which is zero.

    The left-over is given where there are at least two rows for each term; with fewer the fit may be singular.
    """
    panel = cut_lineage(weekly_panel_dense(spark, d))
    found = ax.normal_equations(panel, "seatemperature", M4_REGRESSORS, BY_MUN, ["referencetime"])
    return finish(found.withColumn("moment", F.when(F.col("nobs") >= 2 * F.col("n_terms"), F.col("moment"))))


@register("arimax_score", ["M4"])
def q_arimax_score(spark: SparkSession, d: str) -> DataFrame:
    """Check of the M4 likelihood fit by a fold written apart from it: rows, and where there are two for each term, whether
    the score vanishes and whether the likelihood is at least that at the two-stage estimate."""
    panel = cut_lineage(weekly_panel_dense(spark, d))
    args = (panel, "seatemperature", M4_REGRESSORS, BY_MUN, ["referencetime"])
    _, checks = ax.innovation_series(*args)
    _, start = ax.innovation_series(*args, method=ax.TWO_STAGE)
    both = checks.join(start.select(*BY_MUN, F.col("css").alias("start")), BY_MUN)
    enough = F.col("nobs") >= 2 * (len(M4_REGRESSORS) + 3)
    return both.select(*BY_MUN, "nobs", F.when(enough, F.col("score") < 1e-4).alias("score_is_zero"),
                       F.when(enough, F.col("css") <= F.col("start") * (1 + 1e-9)).alias("not_below_two_stage"))


@register("arimax_report", ["M4", "M7", "E5"])
def q_arimax_report(spark: SparkSession, d: str) -> DataFrame:
    """Residual part of the M4 report: diagnostics of the fit's innovations."""
    panel = cut_lineage(weekly_panel_dense(spark, d))
    series, _ = ax.innovation_series(panel, "seatemperature", M4_REGRESSORS, BY_MUN, ["referencetime"])
    return finish(dg.residual_diagnostics(series, "innovation", BY_MUN, ["referencetime"], lags=1))


@register("series_diagnostics", ["M7"])
def q_series_diagnostics(spark: SparkSession, d: str) -> DataFrame:
    """M7 statistics of the weekly changes of the sea temperature, with four lags."""
    lice = lice_table(spark, d).select("municipalityno", "year", "week", "seatemperature").dropna(subset=["seatemperature"])
    by_week = Window.partitionBy("municipalityno").orderBy("year", "week", "seatemperature")
    change = lice.withColumn("change", F.col("seatemperature") - F.lag("seatemperature").over(by_week))
    return finish(dg.residual_diagnostics(change, "change", BY_MUN, ["year", "week", "seatemperature"], lags=4))


@register("dashboard_model", ["M4", "M7", "V4"])
def q_dashboard_model(spark: SparkSession, d: str) -> DataFrame:
    """The dashboard fit: the chosen lice column on sea temperature and the four weather means/sums."""
    lice_choice = "avgadultfemalelice"
    if lice_choice not in LICE_COLUMNS:
        raise ValueError("Choose lice type")
    coefs, _ = ax.arimax_fit(cut_lineage(combined_table(spark, d)), lice_choice, DASHBOARD_REGRESSORS, BY_MUN, ["referencetime"])
    return finish(coefs)


@register("combine_weekly_notebook", ["E3", "J2", "A6", "A7", "A8", "J3", "R9"])
def q_combine_weekly_notebook(spark: SparkSession, d: str) -> DataFrame:
    """Notebook variant of the flagship: last write per key, inner join (J2), first week kept."""
    return finish(combined_table(spark, d, "notebook"))
