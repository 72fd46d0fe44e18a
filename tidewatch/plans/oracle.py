"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The derived domain views of :mod:`tidewatch.sources.supplied` are restated
here as CTEs; each oracle query prepends the CTEs it needs. Floating outputs
are rounded to 6 decimals and dates cast to DATE on both sides.
"""

from __future__ import annotations

# --- derived views (keep in step with tidewatch/sources/supplied.py) ------------------

_OBS_BASE = """obs_base AS (
  SELECT s.s_nationkey AS municipalityno, 'SN' || CAST(l.l_suppkey AS VARCHAR) AS sourceid,
         l.l_shipdate AS referencetime, 'PT' || CAST(l.l_linenumber AS VARCHAR) || 'H' AS timeoffset,
         l.l_quantity, l.l_discount, l.l_tax, l.l_extendedprice
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey)"""

_OBS = """obs AS (
  SELECT municipalityno, sourceid, referencetime, 'mean(air_temperature P1D)' AS elementid,
         l_quantity * 0.5 - 5.0 AS value, 'degC' AS unit, timeoffset FROM obs_base
  UNION ALL
  SELECT municipalityno, sourceid, referencetime, 'mean(relative_humidity P1D)',
         l_discount * 500.0 + 50.0, 'percent', timeoffset FROM obs_base
  UNION ALL
  SELECT municipalityno, sourceid, referencetime, 'mean(wind_speed P1D)',
         l_tax * 200.0, 'm/s', timeoffset FROM obs_base
  UNION ALL
  SELECT municipalityno, sourceid, referencetime, 'sum(precipitation_amount P1D)',
         l_extendedprice / 1000.0, 'mm', timeoffset FROM obs_base)"""

_REP = """rep AS (
  SELECT c.c_nationkey AS municipalityno, CAST(isoyear(o.o_orderdate) AS INTEGER) AS year,
         CAST(weekofyear(o.o_orderdate) AS INTEGER) AS week,
         CAST(sum(CASE WHEN o.o_orderstatus <> 'P' THEN CAST(o.o_totalprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE)
           / count(CASE WHEN o.o_orderstatus <> 'P' THEN o.o_totalprice ELSE 0 END) / 250000.0 AS avgadultfemalelice,
         CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(o.o_totalprice) / 100000.0 AS avgmobilelice,
         CAST(sum(CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN CAST(o.o_totalprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE)
           / count(CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o.o_totalprice ELSE 0 END) / 500000.0 AS avgstationarylice,
         avg(CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER)) * 3.0 + 2.0 AS seatemperature,
         list_sort(list_distinct(list(CASE o.o_orderstatus WHEN 'F' THEN 'Laks' WHEN 'O' THEN 'Ørret'
                                      WHEN 'P' THEN 'Regnbueørret' END))) AS specieslist
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  GROUP BY 1, 2, 3)"""

_REPN = """repn AS (
  SELECT r.*, n.n_name AS localityname FROM rep r LEFT JOIN nation n ON n.n_nationkey = r.municipalityno)"""

_LICE = """lice AS (
  SELECT sp.municipalityno, sp.localityname, sp.year, sp.week,
         r.avgadultfemalelice, r.avgmobilelice, r.avgstationarylice, r.seatemperature, r.specieslist,
         CAST(make_date(sp.year, 1, 1) + CAST(((6 - (isodow(make_date(sp.year, 1, 1)) - 1)) % 7 + 7) % 7
              + 7 * (sp.week - 1) + 1 AS INTEGER) AS DATE) AS year_week
  FROM (SELECT s.municipalityno, s.localityname, s.year, CAST(w.week AS INTEGER) AS week
        FROM (SELECT DISTINCT municipalityno, year, localityname FROM repn) s, range(1, 53) w(week)) sp
  LEFT JOIN rep r ON r.municipalityno = sp.municipalityno AND r.year = sp.year AND r.week = sp.week)"""

_LOCALITIES = """loc AS (
  SELECT c.c_custkey AS localityno, c.c_name AS name,
         58.0 + (c.c_acctbal + 1000.0) / 11000.0 * 13.0 AS lat,
         4.0 + CAST(c.c_nationkey AS DOUBLE) * 0.5 + CAST(((c.c_custkey % 10) + 10) % 10 AS DOUBLE) / 10.0 AS lon,
         c.c_nationkey AS municipalityno, n.n_name AS municipality
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

_STATIONS = """st AS (
  SELECT 'SN' || CAST(s.s_suppkey AS VARCHAR) AS sourceid,
         58.0 + (s.s_acctbal + 1000.0) / 11000.0 * 13.0 AS lat,
         4.0 + CAST(s.s_nationkey AS DOUBLE) * 0.5 + CAST(((s.s_suppkey % 10) + 10) % 10 AS DOUBLE) / 10.0 AS lon,
         s.s_nationkey AS municipalityno
  FROM supplier s)"""

_FISH = """fish AS (
  SELECT l.localityno, o.o_orderkey AS localityweekid, l.name,
         o.o_orderstatus <> 'P' AS hasreportedlice,
         o.o_orderstatus = 'P' AS isfallow,
         CASE WHEN o.o_orderstatus <> 'P' THEN (CAST(CAST(o.o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT) + 125000) // 250000 / 100.0::DOUBLE END AS avgadultfemalelice,
         o.o_orderpriority = '3-MEDIUM' AS hascleanerfishdeployed,
         o.o_orderpriority = '4-NOT SPECIFIED' AS hasmechanicalremoval,
         o.o_orderpriority = '5-LOW' AS hassubstancetreatments,
         CASE WHEN o.o_orderstatus <> 'P' THEN o.o_orderpriority = '1-URGENT' END AS haspd,
         o.o_orderpriority = '2-HIGH' AS hasila,
         l.municipalityno, l.municipality, l.lat, l.lon,
         false AS isonland, true AS infilteredselection, true AS hassalmonoids,
         (o.o_orderstatus = 'F' AND o.o_orderpriority = '5-LOW') AS isslaughterholdingcage,
         CAST(isoyear(o.o_orderdate) AS INTEGER) AS year, CAST(weekofyear(o.o_orderdate) AS INTEGER) AS week,
         CAST(make_date(CAST(isoyear(o.o_orderdate) AS INTEGER), 1, 1)
              + CAST(((6 - (isodow(make_date(CAST(isoyear(o.o_orderdate) AS INTEGER), 1, 1)) - 1)) % 7 + 7) % 7
              + 7 * (weekofyear(o.o_orderdate) - 1) + 1 AS INTEGER) AS DATE) AS date
  FROM orders o JOIN loc l ON o.o_custkey = l.localityno)"""

_ROSTER = """roster AS (
  SELECT p.p_name || ' ' || CAST(p.p_partkey AS VARCHAR) AS name, p.p_type AS role,
         p.p_brand AS feather_color, string_split(p.p_name, ' ')[1] AS eye_color,
         string_split(p.p_name, ' ')[-1] AS specialty,
         CAST(p.p_size AS INTEGER) AS length_cm, CAST(floor(p.p_retailprice) AS INTEGER) AS weight_g
  FROM part p)"""

# E3 in SQL: A1 -> D3 -> A6 -> A7/A8/J3 -> R9 -> J1 -> R11
_DAILY = """a1 AS (
  SELECT municipalityno, referencetime, elementid, unit, sourceid,
         CAST(isoyear(referencetime) AS VARCHAR) || '_' || CAST(weekofyear(referencetime) AS VARCHAR) AS year_week,
         CAST(avg(CAST(value AS DECIMAL(20,8))) AS DECIMAL(24,12)) AS value
  FROM obs GROUP BY ALL),
d3 AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY municipalityno, referencetime, elementid
                                             ORDER BY unit, sourceid) AS rn FROM a1) WHERE rn = 1),
wide AS (
  SELECT municipalityno, referencetime, year_week,
         max(CASE WHEN elementid = 'mean(air_temperature P1D)' THEN value END) AS mean_air_temperature,
         max(CASE WHEN elementid = 'mean(relative_humidity P1D)' THEN value END) AS mean_relative_humidity,
         max(CASE WHEN elementid = 'mean(wind_speed P1D)' THEN value END) AS mean_wind_speed,
         max(CASE WHEN elementid = 'sum(precipitation_amount P1D)' THEN value END) AS sum_precipitation_amount
  FROM d3 GROUP BY 1, 2, 3)"""

_WEEKLY = """weekly AS (
  SELECT municipalityno, date_trunc('week', referencetime) + INTERVAL 6 DAY AS referencetime,
         avg(mean_air_temperature) AS mean_air_temperature,
         avg(mean_relative_humidity) AS mean_relative_humidity,
         avg(mean_wind_speed) AS mean_wind_speed,
         coalesce(CAST(sum(sum_precipitation_amount) AS DOUBLE), 0.0) AS sum_precipitation_amount,
         max(CASE WHEN referencetime = date_trunc('week', referencetime) + INTERVAL 6 DAY THEN year_week END) AS wk
  FROM wide GROUP BY 1, 2),
weekly_ok AS (
  SELECT * FROM weekly WHERE mean_air_temperature IS NOT NULL AND mean_relative_humidity IS NOT NULL
    AND mean_wind_speed IS NOT NULL AND sum_precipitation_amount IS NOT NULL AND wk IS NOT NULL)"""

_COMBINE = """joined AS (
  SELECT w.municipalityno, w.referencetime, w.mean_air_temperature, w.mean_relative_humidity,
         w.mean_wind_speed, w.sum_precipitation_amount, l.avgadultfemalelice, l.avgmobilelice,
         l.avgstationarylice, l.seatemperature, l.localityname
  FROM weekly_ok w LEFT JOIN lice l
    ON l.municipalityno = w.municipalityno AND CAST(l.year AS VARCHAR) || '_' || CAST(l.week AS VARCHAR) = w.wk),
combined AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY municipalityno ORDER BY referencetime) AS rn FROM joined)
  WHERE rn > 1)"""

CTES = {
    "obs_base": _OBS_BASE, "obs": _OBS, "rep": _REP, "repn": _REPN, "lice": _LICE,
    "loc": _LOCALITIES, "st": _STATIONS, "fish": _FISH, "roster": _ROSTER,
    "daily": _DAILY, "weekly": _WEEKLY, "combine": _COMBINE,
}
_DEPS = {
    "obs": ["obs_base"], "repn": ["rep"], "lice": ["rep", "repn"], "fish": ["loc"],
    "daily": ["obs"], "weekly": ["daily"], "combine": ["weekly", "lice"],
}


def settled(sql: str) -> str:
    """Every ``round(x, 6)`` as a rounding of decimals, like ``catalog.finish``."""
    out, at = "", 0
    while (start := sql.find("round(", at)) >= 0:
        depth, end = 1, start + len("round(")
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        body = sql[start + len("round("):end - 1]
        if body.endswith(", 6)") or not body.endswith(", 6"):
            out, at = out + sql[at:start + len("round(")], start + len("round(")
            continue
        out += f"{sql[at:start]}CAST(round(TRY_CAST({settled(body[:-3])} AS DECIMAL(38,10)), 6) AS DOUBLE)"
        at = end
    return out + sql[at:]


def with_ctes(body: str, *names: str) -> str:
    """Prefix ``body`` with the named CTEs and everything they depend on, in dependency order."""
    order: list[str] = []

    def visit(n: str) -> None:
        for d in _DEPS.get(n, []):
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(CTES[n] for n in order) + "\n" + body
