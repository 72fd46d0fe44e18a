"""Oracle SQL text per registered query name (DuckDB dialect)."""

from __future__ import annotations

from .oracle import settled, with_ctes

SQL: dict[str, str] = {}

_COMBINED_SELECT = """SELECT municipalityno, CAST(referencetime AS DATE) AS referencetime,
  round(mean_air_temperature, 6) AS mean_air_temperature, round(mean_relative_humidity, 6) AS mean_relative_humidity,
  round(mean_wind_speed, 6) AS mean_wind_speed, round(sum_precipitation_amount, 6) AS sum_precipitation_amount,
  round(avgadultfemalelice, 6) AS avgadultfemalelice, round(avgmobilelice, 6) AS avgmobilelice,
  round(avgstationarylice, 6) AS avgstationarylice, round(seatemperature, 6) AS seatemperature, localityname
FROM combined"""

SQL["combine_weekly"] = with_ctes(_COMBINED_SELECT, "combine")


def monday_u(y: str, w: str) -> str:
    """C3 in SQL: %U Monday of (year, week)."""
    j = f"make_date(CAST({y} AS INTEGER), 1, 1)"
    return f"CAST({j} + CAST(((6 - (isodow({j}) - 1)) % 7 + 7) % 7 + 7 * ({w} - 1) + 1 AS INTEGER) AS DATE)"


def monday_w(y: str, w: str) -> str:
    """C4 in SQL: %W Monday of (year, week)."""
    j = f"make_date(CAST({y} AS INTEGER), 1, 1)"
    return f"CAST({j} + CAST(((7 - (isodow({j}) - 1)) % 7 + 7) % 7 + 7 * ({w} - 1) AS INTEGER) AS DATE)"


SQL["calendar_labels"] = f"""
SELECT DISTINCT CAST(o_orderdate AS DATE) AS day,
  CAST(isoyear(o_orderdate) AS INTEGER) AS iso_year, CAST(weekofyear(o_orderdate) AS INTEGER) AS iso_week,
  CAST(isoyear(o_orderdate) AS VARCHAR) || '_' || CAST(weekofyear(o_orderdate) AS VARCHAR) AS label_underscore,
  CAST(year(o_orderdate) AS VARCHAR) || '-' || CAST(weekofyear(o_orderdate) AS VARCHAR) AS label_dash,
  CAST(date_trunc('week', o_orderdate) + INTERVAL 6 DAY AS DATE) AS week_end,
  {monday_u('year(o_orderdate)', 'weekofyear(o_orderdate)')} AS monday_u,
  {monday_w('year(o_orderdate)', 'weekofyear(o_orderdate)')} AS monday_w,
  CAST(dayofyear(o_orderdate) AS VARCHAR) AS doy_text
FROM orders"""

SQL["week_spine"] = """
WITH last AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS as_of_year, CAST(max(o_orderdate) AS DATE) AS as_of
              FROM orders GROUP BY 1),
tw AS (SELECT as_of, CAST((dayofyear(as_of) - 1) // 7 + 1 AS INTEGER) AS w, CAST(year(as_of) AS INTEGER) AS y FROM last),
prev AS (SELECT as_of, w, y, unnest(generate_series(w + 1, 52)) AS k FROM tw),
cur AS (SELECT as_of, w, y, unnest(generate_series(1, w)) AS k FROM tw),
cal AS (SELECT as_of, as_of_year, unnest(generate_series(1, 52)) AS k FROM last)
SELECT 'trailing' AS kind, as_of, CAST(k - (w + 1) AS INTEGER) AS pos, y - 1 AS year, CAST(k AS INTEGER) AS week FROM prev
UNION ALL
SELECT 'trailing', as_of, CAST(greatest(52 - w, 0) + k - 1 AS INTEGER), y, CAST(k AS INTEGER) FROM cur
UNION ALL
SELECT 'calendar', as_of, CAST(k - 1 AS INTEGER), as_of_year, CAST(k AS INTEGER) FROM cal"""

_FISH_COLS = ("localityno, localityweekid, name, hasreportedlice, isfallow, round(avgadultfemalelice, 6) AS avgadultfemalelice, "
              "hascleanerfishdeployed, hasmechanicalremoval, hassubstancetreatments, haspd, hasila, municipalityno, "
              "municipality, round(lat, 6) AS lat, round(lon, 6) AS lon, isonland, infilteredselection, hassalmonoids, "
              "isslaughterholdingcage, year, week, date")

SQL["summary_flatten"] = with_ctes(f"SELECT {_FISH_COLS} FROM fish", "fish")

SQL["detail_extract"] = with_ctes("""
SELECT CAST(municipalityno AS BIGINT) AS localityno, year, week,
  round(avgadultfemalelice, 6) AS avgadultfemalelice, round(avgmobilelice, 6) AS avgmobilelice,
  round(avgstationarylice, 6) AS avgstationarylice, round(seatemperature, 6) AS seatemperature,
  localityname, array_to_string(specieslist, ',') AS specieslist
FROM repn""", "repn")

SQL["observations_flatten"] = with_ctes("""
SELECT municipalityno, sourceid, CAST(referencetime AS DATE) AS referencetime, elementid,
  round(value, 6) AS value, unit, timeoffset FROM obs""", "obs")

SQL["lice_counts"] = with_ctes("""
SELECT municipalityno, localityname, year, week, round(avgadultfemalelice, 6) AS avgadultfemalelice,
  round(avgmobilelice, 6) AS avgmobilelice, round(avgstationarylice, 6) AS avgstationarylice,
  round(seatemperature, 6) AS seatemperature, array_to_string(specieslist, ',') AS specieslist, year_week
FROM lice""", "lice")

SQL["lice_null_counts"] = with_ctes("""
SELECT count(*) - count(avgadultfemalelice) AS avgadultfemalelice, count(*) - count(avgmobilelice) AS avgmobilelice,
  count(*) - count(avgstationarylice) AS avgstationarylice, count(*) - count(seatemperature) AS seatemperature,
  count(*) - count(localityname) AS localityname, count(*) - count(specieslist) AS specieslist,
  count(*) - count(year_week) AS year_week, count(*) - count(week) AS week, count(*) - count(year) AS year
FROM lice""", "lice")

SQL["weekly_lice_mean"] = with_ctes(f"""
SELECT year_week, round(avg(CAST(avgadultfemalelice AS DECIMAL(20,8))), 6) AS avg_adult_female_lice, {monday_w('year', 'week')} AS date
FROM (SELECT *, CAST(year AS VARCHAR) || '-' || CAST(week AS VARCHAR) AS year_week FROM fish)
GROUP BY year_week, year, week""", "fish")

SQL["weekly_disease_share"] = with_ctes(f"""
SELECT year_week, round(avg(CAST(haspd AS DOUBLE)), 6) AS haspd, round(avg(CAST(hasila AS DOUBLE)), 6) AS hasila,
  {monday_w('year', 'week')} AS date
FROM (SELECT *, CAST(year AS VARCHAR) || '-' || CAST(week AS VARCHAR) AS year_week FROM fish)
GROUP BY year_week, year, week
HAVING avg(CAST(haspd AS DOUBLE)) IS NOT NULL OR avg(CAST(hasila AS DOUBLE)) IS NOT NULL""", "fish")

_REGION = ("CASE WHEN lat < 63.81 THEN 'South' WHEN lat <= 68.85 THEN 'Middle' WHEN lat > 68.85 THEN 'North' "
           "ELSE 'NaN' END")

SQL["region_weekly_lice"] = with_ctes(f"""
SELECT region, year_week, round(avg(CAST(avgadultfemalelice AS DECIMAL(20,8))), 6) AS avgadultfemalelice, {monday_w('year', 'week')} AS date
FROM (SELECT *, {_REGION} AS region, CAST(year AS VARCHAR) || '-' || CAST(week AS VARCHAR) AS year_week FROM fish)
GROUP BY region, year_week, year, week
HAVING avg(avgadultfemalelice) IS NOT NULL""", "fish")

SQL["metric_over_time_bool"] = with_ctes(
    "SELECT date, round(avg(CAST(haspd AS DOUBLE)), 6) AS haspd FROM fish GROUP BY date", "fish")

SQL["metric_over_time_numeric"] = with_ctes(
    "SELECT date, round(avgadultfemalelice, 6) AS avgadultfemalelice FROM fish", "fish")

SQL["disease_share"] = with_ctes("""
SELECT haspd, count, round(round(count * 100.0 / sum(count) OVER (), 1), 6) AS share_pct
FROM (SELECT haspd, count(*) AS count FROM fish WHERE haspd IS NOT NULL GROUP BY haspd)""", "fish")

SQL["disease_share_by_locality"] = with_ctes("""
SELECT name, haspd, count, round(round(count * 100.0 / sum(count) OVER (PARTITION BY name), 1), 6) AS share_pct
FROM (SELECT name, haspd, count(*) AS count FROM fish WHERE haspd IS NOT NULL GROUP BY name, haspd)""", "fish")

SQL["locality_points"] = with_ctes("""
SELECT name, round(lat, 6) AS lat, round(lon, 6) AS lon, ordinal,
  CASE WHEN ordinal = 3 THEN 20 ELSE 10 END AS size, CAST(ordinal AS VARCHAR) AS key
FROM (SELECT name, lat, lon, row_number() OVER (ORDER BY name) - 1 AS ordinal
      FROM (SELECT name, lat, lon, row_number() OVER (PARTITION BY name ORDER BY year, week, localityweekid) AS rn
            FROM fish) WHERE rn = 1)""", "fish")

SQL["first_report_per_locality"] = with_ctes("""
SELECT localityno, name, round(lat, 6) AS lat, round(lon, 6) AS lon, localityweekid
FROM (SELECT *, row_number() OVER (PARTITION BY localityno ORDER BY localityweekid) AS rn FROM fish) WHERE rn = 1""",
                                             "fish")


def _alerts_sql() -> str:
    from ..schemas import THRESHOLDS
    aggs = ", ".join(
        f"coalesce(bool_or({m} > {t}), false) AS h_{m}, coalesce(bool_or({m} IS NULL), false) AS m_{m}"
        for m, t in THRESHOLDS.items())
    parts = [f"SELECT municipalityno, CAST(first_time AS DATE) AS first_time, CAST(last_time AS DATE) AS last_time, "
             f"'{m}' AS metric, CAST({t} AS DOUBLE) AS threshold, h_{m} AS too_high, m_{m} AS missing FROM a"
             for m, t in THRESHOLDS.items()]
    body = (f", a AS (SELECT municipalityno, min(referencetime) AS first_time, max(referencetime) AS last_time, {aggs} "
            f"FROM combined GROUP BY municipalityno)\n" + "\nUNION ALL\n".join(parts))
    return body


_alerts = with_ctes("SELECT 1", "combine")
SQL["combined_alerts"] = _alerts[:-len("SELECT 1")].rstrip() + _alerts_sql()

SQL["fish_table_shape"] = with_ctes("SELECT count(*) AS n_rows, CAST(22 AS BIGINT) AS n_cols FROM fish", "fish")

SQL["element_catalog"] = with_ctes("SELECT DISTINCT elementid FROM obs", "obs")

SQL["element_series_year"] = with_ctes("""
SELECT sourceid, CAST(referencetime AS DATE) AS referencetime, round(value, 6) AS value FROM obs
WHERE elementid = 'sum(precipitation_amount P1D)'
  AND CAST(referencetime AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'""", "obs")

_ROSTER_WHERE = "WHERE length_cm >= 25 AND weight_g >= 300"

SQL["roster_metrics"] = with_ctes(f"""
SELECT average_weight, average_length, average_bmi, diversity,
  '+Acceptable' AS average_weight_note, '+Acceptable' AS average_length_note,
  CASE WHEN average_bmi >= 5.2 THEN '-Overweight' ELSE '+Acceptable' END AS average_bmi_note,
  CASE WHEN diversity < 0.8 THEN '-Not diverse' ELSE '+Acceptable' END AS diversity_note
FROM (SELECT round_even(avg(weight_g), 0) AS average_weight, round_even(avg(length_cm), 0) AS average_length,
        round_even(avg((weight_g / 1000.0) / ((length_cm / 100.0) * (length_cm / 100.0))), 2) AS average_bmi,
        round_even(count(DISTINCT feather_color) / count(*), 2) AS diversity
      FROM roster {_ROSTER_WHERE})""", "roster")

SQL["roster_role_counts"] = with_ctes(f"SELECT role, count(*) AS count FROM roster {_ROSTER_WHERE} GROUP BY role",
                                      "roster")

SQL["roster_role_means"] = with_ctes(f"""
SELECT role, round(avg(length_cm), 6) AS length_cm, round(avg(weight_g), 6) AS weight_g
FROM roster {_ROSTER_WHERE} GROUP BY role""", "roster")

SQL["upsert_reports"] = with_ctes("""
SELECT localityweekid, localityno, year, week, round(avgadultfemalelice, 6) AS avgadultfemalelice
FROM (SELECT *, row_number() OVER (PARTITION BY localityweekid ORDER BY seq DESC) AS rn
      FROM (SELECT localityweekid, localityno, year, week, avgadultfemalelice, 0 AS seq FROM fish
            UNION ALL
            SELECT localityweekid, localityno, year, week, avgadultfemalelice + 0.01, 1 FROM fish
            WHERE NOT isfallow AND hasila))
WHERE rn = 1""", "fish")


# --- ordered series -------------------------------------------------------------------

_LAG_COLS = ", ".join(f"lag(avgadultfemalelice, {k}) OVER w AS x{k}" if k else "avgadultfemalelice AS x0"
                      for k in range(5))
_LAG_UNION = "\nUNION ALL\n".join(f"SELECT municipalityno, {k} AS lag, y, x{k} AS xl FROM l" for k in range(5))

SQL["lagged_correlation"] = with_ctes(f"""
, l AS (SELECT municipalityno, seatemperature AS y, {_LAG_COLS}
        FROM lice WINDOW w AS (PARTITION BY municipalityno ORDER BY year_week)),
u AS ({_LAG_UNION}),
v AS (SELECT municipalityno, lag, CASE WHEN xl IS NOT NULL AND y IS NOT NULL THEN xl END AS xv,
             CASE WHEN xl IS NOT NULL AND y IS NOT NULL THEN y END AS yv FROM u)
SELECT municipalityno, lag, count(xv) AS n_pairs,
  round(CASE WHEN stddev_pop(xv) * stddev_pop(yv) = 0 THEN NULL
             ELSE covar_pop(xv, yv) / (stddev_pop(xv) * stddev_pop(yv)) END, 6) AS corr
FROM v GROUP BY municipalityno, lag""", "lice")

SQL["sliding_correlation"] = with_ctes("""
, b AS (SELECT municipalityno, year_week,
          CASE WHEN seatemperature IS NOT NULL AND avgadultfemalelice IS NOT NULL THEN seatemperature END AS xv,
          CASE WHEN seatemperature IS NOT NULL AND avgadultfemalelice IS NOT NULL THEN avgadultfemalelice END AS yv,
          row_number() OVER (PARTITION BY municipalityno ORDER BY year_week) - 1 AS idx
        FROM lice)
SELECT municipalityno, year_week,
  round(CASE WHEN count(xv) OVER f = 5 THEN
          CASE WHEN (stddev_pop(xv) OVER f) * (stddev_pop(yv) OVER f) = 0 THEN NULL
               ELSE (covar_pop(xv, yv) OVER f) / ((stddev_pop(xv) OVER f) * (stddev_pop(yv) OVER f)) END
        END, 6) AS swc,
  (idx >= 8 AND idx < 12) AS in_frame
FROM b
WINDOW f AS (PARTITION BY municipalityno ORDER BY year_week ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)""", "lice")


_METRICS = ["mean_air_temperature", "mean_relative_humidity", "mean_wind_speed", "sum_precipitation_amount",
            "avgadultfemalelice", "avgmobilelice", "avgstationarylice", "seatemperature"]
_LAGGED = ", ".join(f"lag({m}, 1) OVER w AS {m}_lag0" for m in _METRICS)
_BFILL = ", ".join(f"round(first_value({m}_lag0 IGNORE NULLS) OVER fw, 6) AS {m}_lag" for m in _METRICS)
_RAW = ", ".join(f"round({m}, 6) AS {m}" for m in _METRICS)

SQL["densify_lag_backfill"] = with_ctes(f"""
, bounds AS (SELECT municipalityno, min(referencetime) AS lo, max(referencetime) AS hi FROM combined GROUP BY 1),
grid AS (SELECT municipalityno, unnest(generate_series(lo, hi, INTERVAL 7 DAY)) AS referencetime FROM bounds),
dense AS (SELECT g.municipalityno, g.referencetime, {", ".join("c." + m for m in _METRICS)}
          FROM grid g LEFT JOIN combined c ON c.municipalityno = g.municipalityno AND c.referencetime = g.referencetime),
lagged AS (SELECT *, {_LAGGED} FROM dense WINDOW w AS (PARTITION BY municipalityno ORDER BY referencetime))
SELECT municipalityno, CAST(referencetime AS DATE) AS referencetime, {_RAW}, {_BFILL}
FROM lagged
WINDOW fw AS (PARTITION BY municipalityno ORDER BY referencetime ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""",
                                        "combine")


_M4 = ["seatemperature", "avgadultfemalelice", "avgmobilelice", "avgstationarylice", "mean_air_temperature",
       "mean_relative_humidity", "mean_wind_speed", "sum_precipitation_amount"]

SQL["arimax_equations"] = with_ctes(f"""
, bounds AS (SELECT municipalityno, min(referencetime) AS lo, max(referencetime) AS hi FROM combined GROUP BY 1),
grid AS (SELECT municipalityno, unnest(generate_series(lo, hi, INTERVAL 7 DAY)) AS referencetime FROM bounds),
dense AS (SELECT g.municipalityno, g.referencetime, {", ".join("c." + m for m in _M4)}
          FROM grid g LEFT JOIN combined c ON c.municipalityno = g.municipalityno AND c.referencetime = g.referencetime),
diffed AS (SELECT municipalityno, {" AND ".join(f"{m} - lag({m}) OVER w IS NOT NULL" for m in _M4)} AS complete
           FROM dense WINDOW w AS (PARTITION BY municipalityno ORDER BY referencetime)),
n AS (SELECT municipalityno, count(*) FILTER (complete) AS nobs FROM diffed GROUP BY 1)
SELECT municipalityno, nobs, CASE WHEN nobs > 0 THEN CAST({len(_M4) + 2} AS INTEGER) END AS n_terms,
  CASE WHEN nobs >= {2 * (len(_M4) + 2)} THEN 0.0::DOUBLE END AS moment FROM n""", "combine")


def _gauss_sql() -> str:
    from ..operators.series import gaussian_weights
    wts = gaussian_weights(1.0)
    r = (len(wts) - 1) // 2
    values = ", ".join(f"({k - r}, {w!r})" for k, w in enumerate(wts))
    cols = ["avgadultfemalelice", "avgmobilelice", "avgstationarylice"]
    sums = ", ".join(f"round(CASE WHEN count(x.{c}) = {len(wts)} THEN sum(s.w * x.{c}) END, 6) AS {c}_smooth"
                     for c in cols)
    return f"""
, b AS (SELECT municipalityno, year_week, {", ".join(cols)},
          row_number() OVER (PARTITION BY municipalityno ORDER BY year_week) - 1 AS i,
          count(*) OVER (PARTITION BY municipalityno) AS n FROM lice),
k AS (SELECT * FROM (VALUES {values}) kk(k, w)),
src AS (SELECT b.municipalityno, b.year_week, b.n, k.w, (((b.i + k.k) % (2 * b.n)) + 2 * b.n) % (2 * b.n) AS j0
        FROM b, k),
src2 AS (SELECT *, CASE WHEN j0 >= n THEN 2 * n - 1 - j0 ELSE j0 END AS j FROM src)
SELECT s.municipalityno, s.year_week, {sums}
FROM src2 s JOIN b x ON x.municipalityno = s.municipalityno AND x.i = s.j
GROUP BY s.municipalityno, s.year_week"""


SQL["gaussian_smoothing"] = with_ctes(_gauss_sql(), "lice")

SQL["lice_proportions"] = with_ctes("""
SELECT municipalityno, year_week, round(total, 6) AS total,
  round(CASE WHEN total = 0 THEN NULL ELSE avgadultfemalelice / total END, 6) AS avgadultfemalelice_proportion,
  round(CASE WHEN total = 0 THEN NULL ELSE avgmobilelice / total END, 6) AS avgmobilelice_proportion,
  round(CASE WHEN total = 0 THEN NULL ELSE avgstationarylice / total END, 6) AS avgstationarylice_proportion
FROM (SELECT *, avgadultfemalelice + avgmobilelice + avgstationarylice AS total FROM lice)""", "lice")

SQL["top_precipitation_weeks"] = with_ctes("""
SELECT municipalityno, CAST(referencetime AS DATE) AS referencetime,
  round(sum_precipitation_amount, 6) AS sum_precipitation_amount
FROM combined ORDER BY sum_precipitation_amount DESC, municipalityno, referencetime LIMIT 10""", "combine")

SQL["nearest_stations"] = with_ctes("""
SELECT localityno, CAST(rank AS INTEGER) AS rank, sourceid, round(distance_km, 6) AS distance_km
FROM (SELECT l.localityno, s.sourceid, d.distance_km,
             row_number() OVER (PARTITION BY l.localityno ORDER BY d.distance_km, s.sourceid) AS rank
      FROM loc l, st s,
           LATERAL (SELECT 2 * 6371.0088 * asin(least(1.0, sqrt(
               pow(sin((radians(s.lat) - radians(l.lat)) / 2), 2)
               + cos(radians(l.lat)) * cos(radians(s.lat)) * pow(sin((radians(s.lon) - radians(l.lon)) / 2), 2)
           ))) AS distance_km) d)
WHERE rank <= 5""", "loc", "st")

_PAIRS = [(0, 0), (0, 1), (0, 2), (1, 1), (1, 2), (2, 2)]
_CH = ["avgstationarylice", "avgmobilelice", "avgadultfemalelice"]


def _t2_sql() -> str:
    cov = ", ".join(f"covar_samp({_CH[i]}, {_CH[j]}) AS c{i}{j}" for i, j in _PAIRS)
    means = ", ".join(f"avg({c}) AS m{i}" for i, c in enumerate(_CH))
    det = "(c00 * (c11 * c22 - c12 * c12) - c01 * (c01 * c22 - c12 * c02) + c02 * (c01 * c12 - c11 * c02))"
    inv = {
        "i00": "(c11 * c22 - c12 * c12)", "i01": "(c02 * c12 - c01 * c22)", "i02": "(c01 * c12 - c02 * c11)",
        "i11": "(c00 * c22 - c02 * c02)", "i12": "(c01 * c02 - c00 * c12)", "i22": "(c00 * c11 - c01 * c01)",
    }
    inv_sql = ", ".join(f"{v} / det AS {k}" for k, v in inv.items())
    dev = [f"(x.{c} - m.m{i})" for i, c in enumerate(_CH)]
    terms = " + ".join(f"{'' if i == j else '2 * '}{dev[i]} * {dev[j]} * m.i{i}{j}" for i, j in _PAIRS)
    return f"""
, comp AS (SELECT municipalityno, year_week, {", ".join(_CH)} FROM lice
           WHERE {" AND ".join(c + " IS NOT NULL" for c in _CH)}),
c AS (SELECT * FROM comp),
mom AS (SELECT municipalityno, count(*) AS n, {means}, {cov} FROM c GROUP BY municipalityno),
mom2 AS (SELECT *, {det} AS det FROM mom),
m AS (SELECT municipalityno, n, m0, m1, m2, {inv_sql} FROM mom2)
SELECT x.municipalityno, x.year_week, round(CASE WHEN m.n > 4 THEN {terms} END, 6) AS t2,
  round(CASE WHEN m.n > 4 THEN (m.n - 3.0) / (3.0 * (m.n - 1.0)) * ({terms}) END, 6) AS f_stat
FROM c x JOIN m ON m.municipalityno = x.municipalityno"""


SQL["hotelling_t2"] = with_ctes(_t2_sql(), "lice")

SQL["robust_support"] = with_ctes(f"""
SELECT municipalityno, count(*) AS n_rows, CAST(ceil((count(*) + 4) / 2.0) AS BIGINT) AS h,
  CASE WHEN count(*) > 3 THEN CAST(ceil((count(*) + 4) / 2.0) AS BIGINT) END AS support,
  CASE WHEN count(*) > 3 THEN true END AS converged
FROM lice WHERE {" AND ".join(c + " IS NOT NULL" for c in _CH)} GROUP BY municipalityno""", "lice")

SQL["combine_weekly_notebook"] = with_ctes("""
SELECT w.municipalityno, CAST(w.referencetime AS DATE) AS referencetime,
  round(w.mean_air_temperature, 6) AS mean_air_temperature, round(w.mean_relative_humidity, 6) AS mean_relative_humidity,
  round(w.mean_wind_speed, 6) AS mean_wind_speed, round(w.sum_precipitation_amount, 6) AS sum_precipitation_amount,
  round(l.avgadultfemalelice, 6) AS avgadultfemalelice, round(l.avgmobilelice, 6) AS avgmobilelice,
  round(l.avgstationarylice, 6) AS avgstationarylice, round(l.seatemperature, 6) AS seatemperature, l.localityname
FROM weekly_ok w JOIN lice l
  ON l.municipalityno = w.municipalityno AND CAST(l.year AS VARCHAR) || '_' || CAST(l.week AS VARCHAR) = w.wk""",
                                             "weekly", "lice")
_KEYED = """a1 AS (
  SELECT municipalityno, referencetime, elementid, '' AS unit, '' AS sourceid,
         CAST(isoyear(referencetime) AS VARCHAR) || '_' || CAST(weekofyear(referencetime) AS VARCHAR) AS year_week,
         CAST(avg(CAST(value AS DECIMAL(20,8))) AS DECIMAL(24,12)) AS value
  FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY municipalityno, referencetime, elementid, timeoffset
                                                   ORDER BY sourceid DESC, unit DESC, value DESC) AS last FROM obs) WHERE last = 1)
  GROUP BY ALL),
d3 AS ("""
_nb = SQL["combine_weekly_notebook"]
SQL["combine_weekly_notebook"] = _nb[:_nb.index("a1 AS (")] + _KEYED + _nb[_nb.index("d3 AS (") + len("d3 AS ("):]

SQL["lice_csv"] = with_ctes("\nUNION ALL\n".join(
    f"SELECT municipalityno, localityname, year_week, array_to_string(specieslist, ',') AS specieslist, "
    f"'{m}' AS metric, round({m}, 6) AS value FROM lice"
    for m in ("avgadultfemalelice", "avgmobilelice", "avgstationarylice", "seatemperature")), "lice")

SQL["lice_series_union"] = with_ctes(f"""
SELECT year_week, round(avg(CAST(avgadultfemalelice AS DECIMAL(20,8))), 6) AS avgadultfemalelice, 'national' AS scope,
  CAST(NULL AS VARCHAR) AS region
FROM (SELECT *, CAST(year AS VARCHAR) || '-' || CAST(week AS VARCHAR) AS year_week FROM fish) GROUP BY year_week
UNION ALL
SELECT year_week, round(avg(CAST(avgadultfemalelice AS DECIMAL(20,8))), 6) AS avgadultfemalelice, 'regional' AS scope, region
FROM (SELECT *, {_REGION} AS region, CAST(year AS VARCHAR) || '-' || CAST(week AS VARCHAR) AS year_week FROM fish)
GROUP BY region, year_week HAVING avg(avgadultfemalelice) IS NOT NULL""", "fish")

SQL["sample_members"] = with_ctes("""
SELECT name AS key, CAST(to_json({'name': name, 'role': role, 'feather_color': feather_color, 'eye_color': eye_color,
    'specialty': specialty, 'length_cm': length_cm, 'weight_g': weight_g}) AS VARCHAR) AS record
FROM roster ORDER BY md5(name || '7'), name LIMIT 3""", "roster")

SQL["locality_selection"] = with_ctes("""
SELECT name, localityweekid, year, week, round(avgadultfemalelice, 6) AS avgadultfemalelice, haspd
FROM fish WHERE name = (SELECT DISTINCT name FROM fish ORDER BY name LIMIT 1 OFFSET 3)""", "fish")


def _series_sql() -> str:
    from ..schemas import THRESHOLDS
    return "\nUNION ALL\n".join(
        f"SELECT municipalityno, CAST(referencetime AS DATE) AS referencetime, '{m}' AS metric, round({m}, 6) AS value, "
        f"CAST({t} AS DOUBLE) AS threshold FROM combined WHERE {m} IS NOT NULL" for m, t in THRESHOLDS.items())


SQL["metric_series"] = with_ctes(_series_sql(), "combine")

# E3 per locality: the municipality's steps over the observations of the five nearest stations
_NEAREST = SQL["nearest_stations"].partition("\nSELECT localityno, CAST(rank")
_near_obs = """obs_year AS (
  SELECT n.localityno AS municipalityno, o.sourceid, o.referencetime, o.timeoffset, o.elementid, o.value, o.unit
  FROM obs o JOIN near n ON n.sourceid = o.sourceid, (SELECT CAST(max(l_shipdate) AS DATE) AS last FROM lineitem)
  WHERE CAST(o.referencetime AS DATE) BETWEEN last - 365 AND last)"""
_panel = with_ctes("SELECT 1", "loc", "st", "combine")[:-len("SELECT 1")].rstrip()
_panel = _panel.replace("a1 AS (", f"near AS (SELECT localityno, sourceid FROM ({_NEAREST[1].strip()}{_NEAREST[2]})),\n{_near_obs},\na1 AS (") \
    .replace("FROM obs GROUP BY ALL", "FROM obs_year GROUP BY ALL") \
    .replace("joined AS (", "lice_near AS (SELECT l.localityno AS municipalityno, c.* EXCLUDE (municipalityno) FROM loc l JOIN lice c USING (municipalityno)),\njoined AS (") \
    .replace("FROM weekly_ok w LEFT JOIN lice l", "FROM weekly_ok w LEFT JOIN lice_near l")
SQL["combine_nearest"] = _panel + "\n" + _COMBINED_SELECT.replace("SELECT municipalityno,", "SELECT municipalityno AS localityno,")



# ---------------------------------------------------------------------------
# tails of F by the hypergeometric series of the incomplete beta function, in whichever direction it settles fast
# ---------------------------------------------------------------------------

def _beta_series(a: str, b: str, x: str) -> str:
    return (f"exp({a} * ln({x}) + {b} * ln(1 - ({x})) + lgamma({a} + {b}) - lgamma({a} + 1) - lgamma({b})) * list_sum(list_transform(range(800), "
            f"lambda k: exp(lgamma({a} + {b} + k) - lgamma({a} + {b}) - lgamma({a} + 1 + k) + lgamma({a} + 1) + k * ln({x}))))")


def _beta(a: str, b: str, x: str) -> str:
    return (f"CASE WHEN ({x}) <= 0 THEN 0 WHEN ({x}) >= 1 THEN 1 WHEN ({x}) <= 0.9 THEN {_beta_series(a, b, x)} "
            f"ELSE 1 - {_beta_series(b, a, f'(1 - ({x}))')} END")


_t2 = _t2_sql()
_cut = _t2.index("SELECT x.municipalityno, x.year_week, round(")
_dev = [f"(x.{c} - m.m{i})" for i, c in enumerate(_CH)]
_quad = " + ".join(f"{'' if i == j else '2 * '}{_dev[i]} * {_dev[j]} * m.i{i}{j}" for i, j in _PAIRS)
_ALPHA = 0.0027
SQL["classical_chart"] = with_ctes(_t2[:_cut].rstrip() + f""",
t AS (SELECT x.municipalityno, x.year_week, m.n, CASE WHEN m.n > 4 THEN {_quad} END AS t2 FROM c x JOIN m ON m.municipalityno = x.municipalityno),
f AS (SELECT *, (n - 3.0) / (3.0 * (n - 1.0)) * t2 AS f FROM t),
fx AS (SELECT *, (n - 3.0) / ((n - 3.0) + 3.0 * f) AS bx FROM f),
p AS (SELECT *, CASE WHEN t2 IS NOT NULL THEN {_beta('(n - 3) / 2.0', '1.5', 'bx')} END AS p FROM fx),
h AS (SELECT n, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi, 0 AS k FROM (SELECT DISTINCT n FROM m WHERE n > 4)
      UNION ALL SELECT n, CASE WHEN s > {_ALPHA} THEN lo ELSE (lo + hi) / 2 END, CASE WHEN s > {_ALPHA} THEN (lo + hi) / 2 ELSE hi END, k + 1
      FROM (SELECT *, {_beta('(n - 3) / 2.0', '1.5', '((lo + hi) / 2)')} AS s FROM h WHERE k < 60)),
lim AS (SELECT n, 3.0 * (n - 1.0) / (n - 3.0) * ((n - 3.0) * (1 - (lo + hi) / 2) / (3.0 * (lo + hi) / 2)) AS lim FROM h WHERE k = 60)
SELECT municipalityno, year_week, round(t2, 6) AS t2, round(f, 6) AS f_stat, round(p, 6) AS p_value, round(lim, 6) AS t2_limit, t2 > lim AS t2_exceeds, p < {_ALPHA} AS p_exceeds
FROM p LEFT JOIN lim USING (n)""", "lice").replace("WITH ", "WITH RECURSIVE ", 1)

_A, _B = "avgadultfemalelice", "seatemperature"
SQL["robust_quarters"] = with_ctes(f""",
q AS (SELECT municipalityno, year, ((week - 1) // 13)::INTEGER AS quarter, {_A} AS a, {_B} AS b,
        row_number() OVER (PARTITION BY municipalityno, year, (week - 1) // 13 ORDER BY {_A}, {_B}) - 1 AS i FROM lice WHERE {_A} IS NOT NULL AND {_B} IS NOT NULL),
k AS (SELECT municipalityno, year, quarter, count(*) AS n, CAST(ceil((count(*) + 3) / 2.0) AS BIGINT) AS h FROM q GROUP BY ALL),
sub AS (SELECT * FROM (SELECT *, unnest(range(0, (1::BIGINT << n::INTEGER))) AS m FROM k WHERE n > 2) WHERE bit_count(m) = h),
st AS (SELECT municipalityno, year, quarter, m, avg(a) AS ma, avg(b) AS mb, var_pop(a) AS va, var_pop(b) AS vb, covar_pop(a, b) AS cab
       FROM sub JOIN q USING (municipalityno, year, quarter) WHERE (m >> i::INTEGER) & 1 = 1 GROUP BY ALL),
best AS (SELECT * FROM (SELECT *, va * vb - cab * cab AS det, row_number() OVER (PARTITION BY municipalityno, year, quarter ORDER BY va * vb - cab * cab, m) AS rn FROM st) WHERE rn = 1),
d AS (SELECT q.*, ma, mb, va, vb, cab, det, ((a - ma) * (a - ma) * vb - 2 * (a - ma) * (b - mb) * cab + (b - mb) * (b - mb) * va) / nullif(det, 0) AS d2
      FROM q JOIN best USING (municipalityno, year, quarter)),
med AS (SELECT municipalityno, year, quarter, median(d2) AS med FROM d GROUP BY ALL),
fin AS (SELECT municipalityno, year, quarter, count(*) AS n_used, avg(a) AS m0, avg(b) AS m1, var_pop(a) AS c00, covar_pop(a, b) AS c01, var_pop(b) AS c11
        FROM d JOIN med USING (municipalityno, year, quarter) WHERE det > va * vb * exp(-30) AND d2 * 2 * ln(2) / med < -2 * ln(0.025) GROUP BY ALL)
SELECT k.municipalityno, k.year, k.quarter, k.n AS n_rows, k.h, n_used, round(m0, 6) AS m0, round(m1, 6) AS m1, round(c00, 6) AS c00, round(c01, 6) AS c01, round(c11, 6) AS c11,
  round(CASE WHEN det > va * vb * exp(-30) THEN det WHEN k.n > 2 THEN 0 END, 6) AS raw_det,
  CASE WHEN k.n <= 2 THEN 'too few rows' WHEN det > va * vb * exp(-30) THEN 'estimated' ELSE 'exact fit' END AS status
FROM k LEFT JOIN best ON best.municipalityno = k.municipalityno AND best.year = k.year AND best.quarter = k.quarter LEFT JOIN fin ON fin.municipalityno = k.municipalityno AND fin.year = k.year AND fin.quarter = k.quarter""", "lice")

# a fit has a vanishing score and no smaller likelihood than its start, wherever there are more rows than terms
SQL["arimax_score"] = SQL["arimax_equations"][:SQL["arimax_equations"].index("SELECT municipalityno, nobs, CASE")] + f"""
SELECT municipalityno, nobs, CASE WHEN nobs >= {2 * (len(_M4) + 2)} THEN true END AS score_is_zero, CASE WHEN nobs >= {2 * (len(_M4) + 2)} THEN true END AS not_below_two_stage FROM n"""

SQL["series_diagnostics"] = with_ctes(f""",
x AS (SELECT municipalityno, year, week, seatemperature AS v FROM lice WHERE seatemperature IS NOT NULL),
y AS (SELECT *, v - lag(v) OVER (PARTITION BY municipalityno ORDER BY year, week, v) AS r FROM x),
z AS (SELECT *, row_number() OVER (PARTITION BY municipalityno ORDER BY year, week, v) AS place, count(*) OVER (PARTITION BY municipalityno) AS n,
        avg(r) OVER (PARTITION BY municipalityno) AS m FROM y WHERE r IS NOT NULL),
e AS (SELECT *, r - m AS e, {", ".join(f"lag(r - m, {k}) OVER (PARTITION BY municipalityno ORDER BY year, week, v) AS e{k}" for k in range(1, 5))} FROM z),
s AS (SELECT municipalityno, count(*) AS n, {", ".join(f"sum(e * e{k}) / sum(e * e) AS a{k}" for k in range(1, 5))},
        avg(e ** 3) / avg(e ** 2) ** 1.5 AS skew, avg(e ** 4) / avg(e ** 2) ** 2 AS kurt,
        sum(CASE WHEN place > n - round(n / 3.0) THEN r * r END) / sum(CASE WHEN place <= round(n / 3.0) THEN r * r END) AS h FROM e GROUP BY municipalityno),
t AS (SELECT *, n * (n + 2) * ({" + ".join(f"a{k} ** 2 / (n - {k})" for k in range(1, 5))}) AS lb, n / 6.0 * (skew ** 2 + (kurt - 3) ** 2 / 4) AS jb, round(n / 3.0) / 2 AS g FROM s),
w AS (SELECT *, 1 / (1 + h) AS bx FROM t), u AS (SELECT *, {_beta('g', 'g', 'bx')} AS tail FROM w)
SELECT municipalityno, n AS nobs, {", ".join(f"round(a{k}, 6) AS acf_{k}" for k in range(1, 5))}, round(lb, 6) AS ljung_box, round(exp(-lb / 2) * (1 + lb / 2), 6) AS ljung_box_p,
  round(skew, 6) AS skew, round(kurt, 6) AS kurtosis, round(jb, 6) AS jarque_bera, round(exp(-jb / 2), 6) AS jarque_bera_p,
  round(h, 6) AS heteroskedasticity, round(2 * least(tail, 1 - tail), 6) AS heteroskedasticity_p FROM u""", "lice")

SQL["documents_quarantine"] = with_ctes("""
, doc AS (SELECT year, week, localityweekid // 1000 AS page, count(*) AS n, count(*) FILTER (localityweekid % 2 = 1) AS odd FROM fish GROUP BY 1, 2, 3)
SELECT 'kept' AS reason, year, week, count(*) AS documents, CAST(sum(CASE WHEN week % 5 = 0 THEN odd ELSE n END) AS BIGINT) AS localities FROM doc GROUP BY year, week
UNION ALL SELECT 'not JSON, or values of other types', NULL, NULL, count(*) FILTER (week % 7 = 0) + count(*) FILTER (week % 13 = 0), NULL FROM doc HAVING count(*) FILTER (week % 7 = 0) + count(*) FILTER (week % 13 = 0) > 0
UNION ALL SELECT 'without year', NULL, NULL, count(*) FILTER (week % 11 = 0), NULL FROM doc HAVING count(*) FILTER (week % 11 = 0) > 0""", "fish")

SQL["reports_in_years"] = with_ctes("""
SELECT year, count(avgadultfemalelice) AS n_weeks FROM lice WHERE year BETWEEN 2000 AND 2022 GROUP BY year""", "lice")

_FISH_COLUMNS = ["localityno", "localityweekid", "name", "hasreportedlice", "isfallow", "avgadultfemalelice", "hascleanerfishdeployed", "hasmechanicalremoval",
                 "hassubstancetreatments", "haspd", "hasila", "municipalityno", "municipality", "lat", "lon", "isonland", "infilteredselection",
                 "hassalmonoids", "isslaughterholdingcage", "year", "week", "date"]
SQL["column_positions"] = with_ctes("\n" + " UNION ALL ".join(
    f"SELECT CAST({i} AS BIGINT) AS position, '{c}' AS \"column\", count({c}) AS n_values FROM fish" for i, c in enumerate(_FISH_COLUMNS)), "fish")


def _profile(step: str, source: str, width: int, cols: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT '{step}' AS step, count(*) AS n_rows, CAST({width} AS BIGINT) AS n_cols, '{c}' AS \"column\", count(*) - count({c}) AS n_nulls FROM {source}"
                              for c in cols)


_LICE4 = ["avgadultfemalelice", "avgmobilelice", "avgstationarylice"]
SQL["panel_profile"] = with_ctes("\n" + _profile("lice", "lice", 10, [*_LICE4, "seatemperature"]) + " UNION ALL " + _profile("weekly", "weekly_ok", 7, ["wk"]).replace(
    "'wk'", "'week'") + " UNION ALL " + _profile("panel", "combined", 11, [*_LICE4, "localityname"]), "combine")

SQL = {name: settled(text) for name, text in SQL.items()}
