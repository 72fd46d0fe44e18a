"""Joins J1-J6.

* J1/J2: weekly weather joined to the weekly reports on (series key, week label).
* J3/J6: folded into :func:`tidewatch.operators.aggregates.weekly_resample` (no join).
* J4: the site x week fan-out as a generator (``explode(sequence)``), not a cross join.
* J5: exact k-nearest stations with a quadtree whose cells are split where stations are dense; groups of
  near places go down the tree with the few cells that can still hold one of their k nearest, so what they
  look at depends on k and not on distances.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage

EARTH_RADIUS_KM = 6371.0088


def join_weekly(weekly: DataFrame, reports: DataFrame, by: Sequence[str] = (),
                left_label: str = "week", right_label: str = "year_week", how: str = "left") -> DataFrame:
    """J1 (``how='left'``) / J2 (``how='inner'``): weekly rows meet the report with the same label."""
    names = {right_label: "_r_label", **{c: f"_r_{c}" for c in by}}
    right = reports.withColumnsRenamed(names)
    on = [F.col(left_label) == F.col("_r_label"), *[F.col(c) == F.col(names[c]) for c in by]]
    return weekly.join(right, on, how).drop(*[names[c] for c in by], *(["_r_label"] if left_label == right_label else []))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in km."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    dphi = p2 - p1
    dlmb = F.radians(lon2) - F.radians(lon1)
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlmb / 2), 2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def _wrapped(lon: Column) -> Column:
    """Longitude in [-180, 180); one that is there already keeps all its digits."""
    return F.when((lon >= -180.0) & (lon < 180.0), lon).otherwise(F.pmod(lon + 180.0, F.lit(360.0)) - 180.0)


def _to_box_km(lat: Column, lon: Column, box: str) -> Column:
    """Smallest distance from a place to a box of latitudes and longitudes (``<box>_s/_n/_w/_e``), around the globe.

    Beside the box's longitudes the nearest point lies on one of the two meridians that bound it: at the latitude at
    which the distance along the meridian is smallest, if the box has it, else at an end.
    """
    south, north, west, east = (F.col(f"{box}_{c}") for c in "snwe")
    to_lat = F.greatest(south - lat, lat - north, F.lit(0.0))
    out = F.when(lon.between(west, east), F.lit(EARTH_RADIUS_KM) * F.radians(to_lat))
    ways = []
    for side in (west, east):
        turn = F.radians(side - lon)
        foot = F.degrees(F.atan2(F.sin(F.radians(lat)), F.cos(F.radians(lat)) * F.cos(turn)))
        ways += [haversine_km(lat, lon, end, side) for end in (south, north)]
        ways.append(F.when(foot.between(south, north), haversine_km(lat, lon, foot, side)))
    return out.otherwise(F.least(*ways))


#: levels of the finest cells (2^30 by 2^30 of them), and levels from a cell to its children
_DEPTH, _STEP = 30, 2
_SLACK_KM = 1e-6


def _finest(lat: str, lon: str) -> dict[str, Column]:
    """``_ci`` and ``_cj`` of the finest cell that a place is in."""
    inside = lambda part: F.greatest(F.lit(0), F.least(F.lit(2 ** _DEPTH - 1), F.floor(part * 2 ** _DEPTH)))
    return {"_ci": inside((F.col(lat) + 90.0) / 180.0), "_cj": inside((F.col(lon) + 180.0) / 360.0)}


def _cell_at_level() -> dict[str, Column]:
    """``ci`` and ``cj`` of the cell of ``level`` around the finest one."""
    return {c: F.expr(f"shiftright(cast(_{c} as long), {_DEPTH} - level)") for c in ("ci", "cj")}


def station_tree(stations: DataFrame, capacity: int = 64, smallest_deg: float = 0.0) -> tuple[DataFrame, DataFrame]:
    """Quadtree over ``stations`` (_sid, _slat, _slon): (cells, members).

    cells: level, ci, cj, ``_n`` stations, the box they fill, and ``_split``: cells of more than ``capacity``
    stations have the 16 cells two levels below as children, unless these would be smaller than ``smallest_deg``.
    members: each station with the cell without children that it is in. All levels are counted in one
    aggregation, combined before the shuffle.
    """
    last = _DEPTH
    while last > 0 and smallest_deg and 180.0 / 2 ** last < smallest_deg:
        last -= _STEP
    levels = F.explode(F.sequence(F.lit(0), F.lit(last), F.lit(_STEP))).alias("level")
    at = stations.withColumns(_finest("_slat", "_slon")).select("*", levels).withColumns(_cell_at_level())
    cells = cut_lineage(at.groupBy("level", "ci", "cj").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_slat").alias("_b_s"), F.max("_slat").alias("_b_n"),
        F.min("_slon").alias("_b_w"), F.max("_slon").alias("_b_e"))
        .withColumn("_split", (F.col("_n") > capacity) & (F.col("level") < last)))
    split = cells.where("_split").select((F.col("level") + _STEP).alias("level"), F.col("ci").alias("_pi"), F.col("cj").alias("_pj"))
    up = {"_pi": F.shiftright("ci", _STEP), "_pj": F.shiftright("cj", _STEP)}
    cells = cut_lineage(cells.withColumns(up).join(split, ["level", "_pi", "_pj"], "left_semi").unionByName(
        cells.where(F.col("level") == 0).withColumns(up)))
    ends = cells.where(~F.col("_split")).select("level", "ci", "cj")
    return cells, at.select("level", "ci", "cj", "_sid", "_slat", "_slon").join(ends, ["level", "ci", "cj"])


#: places that a group is to have, and has at most; stations beyond which a group's places search one by one
_GROUP, _LARGEST_GROUP, _MANY_STATIONS = 64, 4096, 50_000
#: rows of cells up to which they are sent to all tasks
_BROADCAST_CELLS = 500_000


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= _BROADCAST_CELLS else df


def _grouped_places(places: DataFrame, cells: DataFrame) -> DataFrame:
    """Places (_lat, _lon) with ``_g``, their group: those of a cell that has children no more, or of a part of it if there are many."""
    split = cut_lineage(cells.where("_split").select("level", "ci", "cj"))
    levels = [r.level for r in split.select("level").distinct().collect()]  # one for each level of the tree
    at = places.withColumns(_finest("_lat", "_lon"))
    by = ["_lat", "_lon", "_ci", "_cj"]
    if levels:
        at = at.select("*", F.explode(F.array(*[F.lit(x) for x in levels])).alias("level")).withColumns(_cell_at_level()) \
            .join(_small(split), ["level", "ci", "cj"], "left_semi").groupBy(*by).agg((F.max("level") + _STEP).alias("level"))
    else:
        at = at.withColumn("level", F.lit(0))
    cell = ["level", "ci", "cj"]
    at = at.withColumns(_cell_at_level())
    n = at.groupBy(*cell).agg(F.count(F.lit(1)).alias("_places"))
    deeper = F.ceil(F.log2(F.col("_places") / _GROUP) / (2 * _STEP)) * _STEP
    at = at.join(n, cell).withColumn("level", F.least(F.lit(_DEPTH), F.col("level") + F.greatest(F.lit(0), deeper)).cast("int")) \
        .select(*by, "level").withColumns(_cell_at_level())
    n = at.groupBy(*cell).agg(F.count(F.lit(1)).alias("_places"))
    part = F.pmod(F.xxhash64("_lat", "_lon"), F.ceil(F.col("_places") / _LARGEST_GROUP))
    return at.join(n, cell).select("_lat", "_lon", F.concat_ws("/", *cell, part).alias("_g"))


def _near_cells(grouped: DataFrame, cells: DataFrame, n_stations: int, k: int) -> DataFrame:
    """(_g, level, ci, cj, _n) of the cells that can hold one of the k nearest stations of a place of a group.

    A group is searched from the middle of its places, with twice its radius added to the bound of the k-th distance: by the
    triangle inequality no nearest station of any of its places is farther than that.
    """
    cell = ["level", "ci", "cj"]
    box = grouped.groupBy("_g").agg(F.min("_lat").alias("_s"), F.max("_lat").alias("_n"), F.min("_lon").alias("_w"), F.max("_lon").alias("_e"))
    middle_lat, middle_lon = (F.col("_s") + F.col("_n")) / 2, (F.col("_w") + F.col("_e")) / 2
    # along the middle's parallel, then along a meridian
    radius = F.lit(EARTH_RADIUS_KM) * (F.radians((F.col("_e") - F.col("_w")) / 2) * F.cos(F.radians(middle_lat)) + F.radians((F.col("_n") - F.col("_s")) / 2))
    # down to the deepest cell that has all stations there is nothing to choose
    root = cells.where(F.col("_n") == n_stations).orderBy(F.desc("level")).select(*cell, "_split").first()
    by = ["_g", "_lat", "_lon", "_radius"]
    left = cut_lineage(box.select("_g", middle_lat.alias("_lat"), middle_lon.alias("_lon"), radius.alias("_radius"),
                                  F.lit(root.level).alias("level"), F.lit(root.ci).cast("long").alias("ci"),
                                  F.lit(root.cj).cast("long").alias("cj"), F.lit(n_stations).cast("long").alias("_n"),
                                  F.lit(None).cast("double").alias("_near"), F.lit(None).cast("double").alias("_far"),
                                  F.lit(root["_split"]).alias("_split")))
    nearest_first = Window.partitionBy("_g").orderBy("_far", *cell).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    children = cells.select((F.col("level") - _STEP).alias("level"), F.col("_pi").alias("ci"), F.col("_pj").alias("cj"),
                            F.struct(*cell).alias("_child"), "_n", "_split", *[F.col(f"_b_{c}") for c in "snwe"])
    # all groups begin in one cell, whose children (16 at most) go to every task
    below = F.broadcast(children.where((F.col("level") == root.level) & (F.col("ci") == root.ci) & (F.col("cj") == root.cj)))
    going_on = root["_split"]
    while going_on:
        here = [F.col("_lat"), F.col("_lon")]
        # the farthest point of a box is the one nearest to the place on the other side of the globe
        antipode = [-F.col("_lat"), _wrapped(F.col("_lon") + 180.0)]
        opened = left.where("_split").select(*by, *cell).join(below, cell).select(
            *by, "_child.*", "_n", _to_box_km(*here, "_b").alias("_near"),
            (F.lit(math.pi * EARTH_RADIUS_KM) - _to_box_km(*antipode, "_b")).alias("_far"), "_split")
        both = left.where(~F.col("_split")).unionByName(opened)
        reached = F.sum("_n").over(nearest_first)
        bound = F.min(F.when(F.col("_reached") >= k, F.col("_far"))).over(Window.partitionBy("_g"))
        left = cut_lineage(both.withColumn("_reached", reached).withColumn("_bound", bound)
                           .where(F.col("_bound").isNull() | (F.col("_near") <= F.col("_bound") + 2 * F.col("_radius") + _SLACK_KM))
                           .drop("_reached", "_bound"))
        going_on = not left.where("_split").limit(1).isEmpty()
        below = children
    return left.select("_g", *cell, "_n")


def _likely_nearest(k: int):
    """Cogrouped map: places and stations of a group -> the pairs that may be among the k nearest, by squared chords.

    It keeps more than rounding can move; the pairs' distances and ranks are found from the places themselves.
    """
    def on_sphere(lat, lon):
        a, b = np.radians(lat), np.radians(lon)
        return np.cos(a) * np.cos(b), np.cos(a) * np.sin(b), np.sin(a)

    def run(places: pa.Table, stations: pa.Table) -> pa.Table:
        here = on_sphere(places["_lat"].to_numpy(), places["_lon"].to_numpy())
        there = on_sphere(stations["_slat"].to_numpy(), stations["_slon"].to_numpy())
        n, rows, cols = stations.num_rows, [], []
        if n:
            step = max(1, 1_000_000 // n)
            for at in range(0, places.num_rows, step):
                chord = sum((a[at:at + step, None] - b) ** 2 for a, b in zip(here, there))
                last = np.partition(chord, min(k, n) - 1, axis=1)[:, min(k, n) - 1]
                i, j = np.nonzero(chord <= (last * (1 + 1e-9) + 1e-14)[:, None])
                rows.append(i + at)
                cols.append(j)
        i, j = (np.concatenate(x) if x else np.empty(0, int) for x in (rows, cols))
        return pa.table([*[places[c].take(i) for c in ("_lat", "_lon")], *[stations[c].take(j) for c in ("_sid", "_slat", "_slon")]],
                        names=["_lat", "_lon", "_sid", "_slat", "_slon"])
    return run


def nearest_stations(sites: DataFrame, stations: DataFrame, k: int = 5, site_key: str = "localityno",
                     station_key: str = "sourceid", cell_deg: float | None = None,
                     lat: str = "lat", lon: str = "lon", capacity: int = 64) -> DataFrame:
    """The ``k`` nearest stations of every site, ordered nearest first (ties by station id).

    Output: (site_key, rank 1..k, station_key, distance_km). Exact. Distances go around the globe: longitudes may be given
    in any turn, and stations across the 180° meridian are neighbours. Stations without coordinates are
    nobody's neighbours; a site without coordinates, and every site if there is no station, comes back
    once with null rank, station and distance.

    Stations lie in a quadtree whose cells are split while they hold more than ``capacity`` stations (and are larger than
    ``cell_deg``, if given). Near places are a group. All groups go down the tree together, one round a level of the tree: the
    cells that a group still has are replaced by their children; those that together surely hold k stations bound its
    k-th distance, and cells beyond that bound are left out. Where a group is left with very many stations, its places
    go down one by one. A group's places and stations meet in one task. Sites at one place are searched once, and of
    the stations at one place only the k first are kept, so neither makes a cell that can't be split.
    """
    ok = lambda a, b: F.col(a).isNotNull() & F.col(b).isNotNull() & ~F.isnan(a) & ~F.isnan(b)
    # adding 0 makes -0.0 and 0.0 one value
    st = stations.select(F.col(station_key).alias("_sid"), F.col(lat).cast("double").alias("_slat"), F.col(lon).cast("double").alias("_slon")) \
        .where(ok("_slat", "_slon")).withColumns({"_slat": F.col("_slat") + 0.0, "_slon": _wrapped(F.col("_slon")) + 0.0})
    same_place = Window.partitionBy("_slat", "_slon").orderBy("_sid")
    st = cut_lineage(st.withColumn("_rank", F.row_number().over(same_place)).where(F.col("_rank") <= k).drop("_rank"))
    nothing = [F.lit(None).cast("int").alias("rank"), F.lit(None).cast(stations.schema[station_key].dataType).alias(station_key),
               F.lit(None).cast("double").alias("distance_km")]
    if st.isEmpty():
        return sites.select(F.col(site_key), *nothing)
    placed = sites.select(F.col(site_key), F.col(lat).cast("double").alias("_lat"), F.col(lon).cast("double").alias("_lon"))
    unplaced = placed.where(~ok("_lat", "_lon")).select(F.col(site_key), *nothing)
    placed = placed.where(ok("_lat", "_lon")).withColumns({"_lat": F.col("_lat") + 0.0, "_lon": _wrapped(F.col("_lon")) + 0.0})
    cells, members = station_tree(st, capacity, cell_deg or 0.0)

    by = ["_lat", "_lon"]
    cell = ["level", "ci", "cj"]
    n_stations = st.count()
    grouped = cut_lineage(_grouped_places(placed.select(*by).distinct(), cells))
    left = _near_cells(grouped, cells, n_stations, k)
    crowded = cut_lineage(left.groupBy("_g").agg(F.sum("_n").alias("_all")).where(F.col("_all") > _MANY_STATIONS).select("_g"))
    if not crowded.isEmpty():
        alone = cut_lineage(grouped.join(crowded, "_g", "left_semi").withColumn("_g", F.concat_ws(" ", *by)))
        grouped = grouped.join(crowded, "_g", "left_anti").unionByName(alone)
        left = left.join(crowded, "_g", "left_anti").unionByName(_near_cells(alone, cells, n_stations, k))
    pairs = T.StructType([T.StructField("_lat", T.DoubleType()), T.StructField("_lon", T.DoubleType()), *members.select("_sid", "_slat", "_slon").schema])
    likely = grouped.groupBy("_g").cogroup(left.join(members, cell).select(F.col("_g").alias("_group"), "_sid", "_slat", "_slon").groupBy("_group")).applyInArrow(
        _likely_nearest(k), pairs)
    rank = Window.partitionBy(*by).orderBy("_dist", "_sid")
    found = likely.select(
        *by, "_sid", haversine_km(F.col("_lat"), F.col("_lon"), F.col("_slat"), F.col("_slon")).alias("_dist")) \
        .withColumn("_rank", F.row_number().over(rank)).where(F.col("_rank") <= k)
    return placed.join(found, by).select(
        site_key, F.col("_rank").cast("int").alias("rank"), F.col("_sid").alias(station_key),
        F.col("_dist").alias("distance_km")).unionByName(unplaced)
