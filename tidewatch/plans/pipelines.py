"""End-to-end pipelines E1-E3 as single lazy plans (no file hand-off between stages).

E4 (process control) lives in :mod:`tidewatch.operators.robust`, E5 (forecasting
study) in :mod:`tidewatch.operators.arimax`; both are composed in
:mod:`tidewatch.plans.catalog`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..operators import aggregates as agg
from ..operators import filters as flt
from ..operators import joins as jn
from ..operators import reshape as rs
from ..operators.ordinal import with_ordinal
from ..schemas import ELEMENT_COLUMNS, ELEMENTS, MEAN_ELEMENTS, SUM_ELEMENTS
from ..session import cut_lineage

# Columns of the combined table, in its order.
COMBINED_COLUMNS = ["referencetime", "mean_air_temperature", "mean_relative_humidity", "mean_wind_speed",
                    "sum_precipitation_amount", "avgadultfemalelice", "avgmobilelice", "avgstationarylice",
                    "seatemperature", "localityname"]


def daily_wide(observations: DataFrame, by: Sequence[str] = (), mode: str = "script") -> DataFrame:
    """E3 first half: long observations -> one row per (by, day) with the four elements as columns.

    A1 mean over time offsets, D3 smallest (unit, sourceid) wins, A6 pivot — two
    aggregations, the second keyed by (by, day) only. The ISO labels (C5/C6)
    are functions of the day, so they are computed after aggregating instead of
    being carried as grouping keys through the hot shuffle.

    ``mode='notebook'``: the keyed store keeps one value per (day, element, time offset), the last written:
    of the largest station, then unit and value. Its values are averaged over the time offsets.
    """
    obs = flt.restrict_sources(observations)
    # the four element ids become a small integer code for the shuffles (narrower rows)
    code = F.array_position(F.array(*[F.lit(e) for e in ELEMENTS]), F.col("elementid")).cast("byte")
    obs = obs.withColumn("_element", code)
    codes = list(range(1, len(ELEMENTS) + 1))
    names = dict(zip(codes, ELEMENTS))
    if mode == "notebook":
        kept = obs.groupBy(*by, "referencetime", "_element", "timeoffset").agg(
            F.max(F.struct("sourceid", "unit", "value"))["value"].alias("value"))
        daily = agg.mean_by(kept, [*by, "referencetime", "_element"], "value", exact=True)
        return _labelled(rs.pivot_first(daily, [*by, "referencetime"], "_element", codes, value_col="value", names=names))
    # D3 compares the place of (unit, station) in their order, a number: keys are narrow and all aggregations hash-based
    obs = _with_ranks(obs).select(*by, "referencetime", "_element", "_rank", "value").dropna(subset=[*by, "referencetime", "_element"])
    # the smallest is found first, so that only its observations are averaged: the others never reach a shuffle
    cell = [*by, "referencetime", "_element"]
    first = cut_lineage(obs.groupBy(*cell).agg(F.min("_rank").alias("_rank")))
    daily = agg.mean_by(obs.join(_small(first), [*cell, "_rank"], "left_semi"), [*cell, "_rank"], "value", exact=True)
    return _labelled(rs.pivot_first(daily, [*by, "referencetime"], "_element", codes, value_col="value",
                                    order_cols=["_rank"], names=names))


#: rows up to which a checkpointed table of numbers and short texts is sent to all tasks; beyond, Spark plans the join
BROADCAST_ROWS = 1_000_000
#: bits of a rank that hold the station
_STATION_BITS = 40


def _small(df: DataFrame) -> DataFrame:
    """A checkpointed table with the hint to broadcast it if it is small."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _with_ranks(obs: DataFrame, among: DataFrame | None = None) -> DataFrame:
    """``obs`` with ``_rank``, a number in the order of (unit, sourceid); units and stations are numbered apart, those of
    ``among`` (``obs`` itself by default)."""
    pairs = cut_lineage((obs if among is None else among).select("unit", "sourceid").distinct())
    rank = F.lit(0).cast("long")
    for name, bits in (("unit", _STATION_BITS), ("sourceid", 0)):
        places = with_ordinal(pairs.select(F.col(name).alias("_name")).distinct(), ["_name"], f"_{name}")
        obs = obs.join(_small(cut_lineage(places)), obs[name].eqNullSafe(F.col("_name"))).drop("_name")
        rank = rank + F.shiftleft(f"_{name}", bits)
    return obs.withColumn("_rank", rank).drop("_unit", "_sourceid")


def _labelled(wide: DataFrame) -> DataFrame:
    ts = F.col("referencetime")
    return wide.withColumn("year_week", cal.year_week_label(cal.iso_year(ts), cal.iso_week(ts), "_"))


def weekly_weather(observations: DataFrame, by: Sequence[str] = (), mode: str = "script") -> DataFrame:
    """E3 middle: A7 means, A8 zero-filled sum, J3 Sunday label, R9 complete weeks only."""
    return _weekly(daily_wide(observations, by, mode), by)


def _weekly(wide: DataFrame, by: Sequence[str]) -> DataFrame:
    weekly = agg.weekly_resample(wide, "referencetime", by, mean_cols=MEAN_ELEMENTS, sum_cols=SUM_ELEMENTS,
                                 sunday_flag="_has_sunday")
    # The label is the ISO label of the row stamped on the Sunday itself, i.e. of the Sunday
    ts = F.col("referencetime")
    weekly = weekly.withColumn("week", F.when(F.col("_has_sunday"),
                                              cal.year_week_label(cal.iso_year(ts), cal.iso_week(ts), "_")))
    return flt.drop_any_null(weekly, [*MEAN_ELEMENTS, *SUM_ELEMENTS, "week"]).drop("_has_sunday")


def lice_counts(reports: DataFrame, by: Sequence[str] = ("municipalityno",),
                descriptors: Sequence[str] = ("localityname",), n_weeks: int = 52) -> DataFrame:
    """Every (series, year) with a report gets weeks 1..52 (J4/C1); each week takes its report
    (S2/P2) or nulls; ``year_week`` is the %U Monday (C3); columns lower-cased (P4).

    One aggregation per (series, year) collects the year's reports (one a week, or a few:
    bounded by the calendar, not by the data), and the spine is generated from it — no second scan of
    the reports and no join. Several reports of a week give as many rows, as a join would.
    """
    keys = [*by, "year"]
    measures = [c for c in reports.columns if c not in (*keys, "week", *descriptors)]
    per_year = reports.groupBy(*keys).agg(
        *[F.first(d, ignorenulls=True).alias(d) for d in descriptors],
        F.collect_list(F.struct(F.col("week"), F.struct(*measures).alias("r"))).alias("_weeks"))
    spine = per_year.select(*keys, *descriptors, "_weeks",
                            F.explode(F.sequence(F.lit(1), F.lit(int(n_weeks)))).alias("week"))
    mine = F.filter("_weeks", lambda w: w["week"] == F.col("week"))
    spine = spine.select(*keys, *descriptors, "week", F.explode_outer(mine).alias("_rep"))
    out = spine.select(*keys, *descriptors, "week", *[F.col("_rep.r")[m].alias(m) for m in measures])
    out = out.withColumn("year_week", cal.monday_sunday_first("year", "week"))
    return rs.lower_columns(out)


def combine(observations: DataFrame, lice: DataFrame, by: Sequence[str] = ("municipalityno",),
            mode: str = "script", drop_empty_columns: bool = False) -> DataFrame:
    """E3 flagship: weekly weather joined to the weekly lice counts, one row per (by, week).

    ``mode='script'``: left join (J1) and the first week of every series dropped (R11);
    ``mode='notebook'``: last write per key instead of D3, inner join (J2), first week kept. ``drop_empty_columns``
    applies P8 to the lice side first (costs one extra aggregate pass).
    """
    weekly = weekly_weather(observations, by, mode)
    if drop_empty_columns:
        lice = rs.drop_all_null_columns(lice)
    return with_lice(weekly, lice, by, mode)


def with_lice(weekly: DataFrame, lice: DataFrame, by: Sequence[str], mode: str = "script") -> DataFrame:
    """E3 end: weekly weather with the lice counts of its week (J1/J2), in the combined columns; R11 in the script's mode."""
    lice = lice.withColumn("_label", cal.year_week_label("year", "week", "_")) \
        .select(*by, "_label", *[c for c in ("avgadultfemalelice", "avgmobilelice", "avgstationarylice",
                                            "seatemperature", "localityname") if c in lice.columns])
    how = "left" if mode == "script" else "inner"
    joined = jn.join_weekly(weekly, lice, by, left_label="week", right_label="_label", how=how)
    renamed = rs.rename_columns(joined, ELEMENT_COLUMNS)
    out = renamed.select(*by, *[c for c in COMBINED_COLUMNS if c in renamed.columns])
    if mode == "script":
        out = flt.drop_first_row(out, by, ["referencetime"])
    return out


def combine_nearest(observations: DataFrame, lice: DataFrame, sites: DataFrame, stations: DataFrame, k: int = 5,
                    as_of=None, site_key: str = "localityno", area: str = "municipalityno") -> DataFrame:
    """E3 per site: J5 nearest ``k`` stations -> R6 the 365 days up to ``as_of`` -> R7 those stations -> weekly panel.

    ``lice`` is the E2 table by ``area``; a site takes its area's reports. Observations are averaged (A1) and pivoted per
    station and day before they meet the choices, so that one row a station and day goes to each set of stations that has
    the station, and the weeks of a set to its sites. Stations are ranked by (unit, station) once; D3 then compares numbers, and both pivots stay hash aggregations.
    """
    found = jn.nearest_stations(sites, stations, k=k, site_key=site_key).where(F.col("rank").isNotNull()).select(site_key, "sourceid")
    # which station is nearer makes no difference to the panel: sites that chose the same stations share one
    sets = found.groupBy(site_key).agg(F.array_sort(F.collect_set("sourceid")).alias("_stations")) \
        .withColumns({"_s1": F.xxhash64("_stations"), "_s2": F.xxhash64(F.lit(1), "_stations")})
    sets = cut_lineage(sets)
    by_set = ["_s1", "_s2"]
    chosen = sets.select(*by_set, F.explode("_stations").alias("sourceid")).distinct()
    year = flt.date_range(observations, "referencetime", as_of=as_of)
    obs = flt.restrict_sources(year, chosen)
    daily = agg.mean_by(obs, ["sourceid", "referencetime", "elementid", "unit"], "value", exact=True)
    daily = _with_ranks(daily, year).select("sourceid", "referencetime", "elementid", "value", "_rank")
    of = {e: F.when(F.col("elementid") == F.lit(e), F.col("_rank")) for e in ELEMENTS}
    by_station = daily.groupBy("sourceid", "referencetime").agg(
        *[F.min_by("value", rank).alias(f"_v{i}") for i, rank in enumerate(of.values())], *[F.min(rank).alias(f"_r{i}") for i, rank in enumerate(of.values())])
    per_set = by_station.join(chosen, "sourceid")
    wide = per_set.groupBy(*by_set, "referencetime").agg(*[F.min_by(f"_v{i}", f"_r{i}").alias(e) for i, e in enumerate(ELEMENTS)])
    weekly = _weekly(wide, by_set).join(sets.select(site_key, *by_set), by_set).drop(*by_set)
    place = sites.select(site_key, area)
    reports = lice.where(F.col("year").between(F.year(F.lit(as_of)) - 1, F.year(F.lit(as_of)) + 1)).join(place, area)
    return with_lice(weekly, reports, [site_key], "script")


def year_summary(summary_docs: DataFrame) -> DataFrame:
    """Weekly summary documents -> flat locality-week rows (P1/U1) + %U Monday ``date`` (C3) + P4."""
    flat = rs.flatten_localities(summary_docs)
    flat = flat.withColumn("date", cal.monday_sunday_first("year", "week"))
    return rs.lower_columns(flat)
