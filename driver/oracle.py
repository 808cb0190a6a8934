"""SQL twins of the registered queries, for DuckDB over the same tables."""

from __future__ import annotations


def r(expression: str, name: str | None = None) -> str:
    """Four decimals (summation noise off first), no negative zero."""
    return f"round(round({expression}, 10), 4) + 0.0 AS {name or expression}"


def i(expression: str, name: str | None = None) -> str:
    return f"CAST({expression} AS BIGINT) AS {name or expression}"


def q(ctes: list[str], body: str) -> str:
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + body


def season_t(day: str) -> str:
    return f"14 - 11*cos(2*pi()*(dayofyear({day})-15)/365)"


def daily(name: str, station: str) -> str:
    return f"""{name} AS (
  SELECT station_id, day, {season_t('day')} + (qty-25.5)/2 AS t_db, p/(63*pi()) AS ghi, 40+c*(188*pi()) AS rh, x*(31*pi()) AS v_air
  FROM (SELECT {station} AS station_id, CAST(l_shipdate AS DATE) AS day, avg(l_quantity) AS qty,
               avg(l_extendedprice) AS p, avg(l_discount) AS c, avg(l_tax) AS x
        FROM lineitem GROUP BY 1, 2))"""


SUP = daily("sup", "l_suppkey")
FLAG = daily("flag", "l_returnflag")
FIELD = """CASE event_type WHEN 'click' THEN 't_db' WHEN 'view' THEN 'rh' WHEN 'error' THEN 'v_air'
  WHEN 'purchase' THEN 'p_atm' WHEN 'signup' THEN 'ghi' END"""
POINTS = f"pts AS (SELECT user_id AS station_id, event_id, ts, {FIELD} AS field, value*(pi()/10) AS value FROM events)"
END = "date_trunc('hour', ts) + INTERVAL 1 HOUR"


def wide(name: str, fields: list[str], label: str = END, where: str = "") -> str:
    """Hourly means of :data:`POINTS`, one column per field."""
    wanted = ", ".join(f"'{f}'" for f in fields)
    means = ", ".join(f"avg(value) FILTER (field = '{f}') AS {f}" for f in fields)
    return f"{name} AS (SELECT station_id, {label} AS ts, {means} FROM pts WHERE field IN ({wanted}) {where} GROUP BY 1, 2)"


def filled(name: str, source: str, fields: list[str], start: str, stop: str) -> str:
    """Dense spine, then forward and backward fill within the hour of day."""
    cols = ", ".join(f"s.{f}" for f in fields)
    fill = ", ".join(f"coalesce(last_value({f} IGNORE NULLS) OVER up, first_value({f} IGNORE NULLS) OVER down) AS {f}"
                     for f in fields)
    return f"""{name}_spine AS (
  SELECT station_id, ts FROM (SELECT DISTINCT station_id FROM {source} WHERE ts BETWEEN TIMESTAMP '{start}' AND TIMESTAMP '{stop}'),
         (SELECT unnest(generate_series(TIMESTAMP '{start}', TIMESTAMP '{stop}', INTERVAL 1 HOUR)) AS ts)),
{name} AS (
  SELECT station_id, ts, {fill}
  FROM (SELECT p.station_id, p.ts, {cols} FROM {name}_spine p LEFT JOIN {source} s USING (station_id, ts))
  WINDOW up AS (PARTITION BY station_id, hour(ts) ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         down AS (PARTITION BY station_id, hour(ts) ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""


JANUARY = ("2024-01-01 00:00:00", "2024-01-31 23:00:00")
PLACES = """places AS (
  SELECT station_id, 36 + (station_id*7 % 290)/10 AS lat, -9 + (station_id*13 % 370)/10 + CASE WHEN station_id % 3 = 2 THEN 77 ELSE 0 END AS lon,
         CASE station_id % 3 WHEN 0 THEN 'Europe/Rome' WHEN 1 THEN 'Europe/London' ELSE 'Asia/Kolkata' END AS tz
  FROM (SELECT DISTINCT station_id FROM pts))"""
SUP_PLACES = """sup_places AS (
  SELECT s_suppkey AS station_id, 35 + s_suppkey%23 + s_acctbal/10000 AS lat,
         -10 + s_suppkey%31 + s_acctbal/30000 AS lon FROM supplier)"""
FLAG_PLACES = """flag_places AS (
  SELECT station_id, round(20 + ascii(station_id)/3, 2) AS lat, round(ascii(station_id)/6 - 4, 2) AS lon, 'Europe/Rome' AS tz
  FROM (SELECT DISTINCT l_returnflag AS station_id FROM lineitem))"""
HOUR_FIELDS = ["t_db", "rh", "v_air", "wind_dir", "rain", "prec_rate", "ghi", "p_atm_min", "p_atm_max"]
LINE_HOURS = f"""obs AS (
  SELECT l_returnflag AS station_id, (l_orderkey + 5*l_linenumber) % 24 AS h,
         l_shipdate + to_hours(CAST((l_orderkey + 5*l_linenumber) % 24 AS INTEGER)) + to_minutes(l_partkey % 60) AS ts,
         {season_t('CAST(l_shipdate AS DATE)')} + 4*sin(2*pi()*((l_orderkey + 5*l_linenumber) % 24 - 9)/24)
           + (l_quantity-25.5)/5 AS t_db,
         40 + l_discount*(188*pi()) AS rh, l_tax*(31*pi()) AS v_air, l_extendedprice*pi() % 360 AS wind_dir,
         CASE WHEN l_quantity > 40 THEN l_tax*(16*pi()) ELSE 0 END AS rain, l_discount*(9*pi()) AS prec_rate,
         greatest(0, sin(pi()*((l_orderkey + 5*l_linenumber) % 24 - 6)/12))*(300 + l_extendedprice/(63*pi())) AS ghi,
         990 + l_quantity/3 AS p_atm_min, 1010 + l_quantity/3 AS p_atm_max
  FROM lineitem),
hours AS (SELECT station_id, {END} AS ts, {', '.join(f'avg({f}) AS {f}' for f in HOUR_FIELDS)} FROM obs GROUP BY 1, 2)"""
SUP_HOURS = [LINE_HOURS.replace("l_returnflag AS station_id", "l_suppkey AS station_id"), "suph AS (SELECT *, year(ts) AS year FROM hours)"]
ALL_YEARS = ("1995-01-01 00:00:00", "2001-12-31 23:00:00")


def km(lat1: str, lon1: str, lat2: str, lon2: str, radius: float = 6371.0) -> str:
    a = (f"(pow(sin(radians({lat2}-({lat1}))/2), 2) + cos(radians({lat1}))*cos(radians({lat2}))"
         f"*pow(sin(radians({lon2}-({lon1}))/2), 2))")
    return f"2*{radius}*asin(sqrt({a}))"


def not_leap(d: str) -> str:
    return f"NOT (month({d}) = 2 AND day({d}) = 29)"


def in_1970(d: str) -> str:
    return f"make_timestamp(1970, month({d}), day({d}), hour({d}::TIMESTAMP), 0, 0)"


def dew(t: str, rh: str) -> str:
    return f"CASE WHEN {rh} <> 0 THEN 1/(1/({t}+273.15) - 1.85e-4*ln({rh}/100)) - 273.15 END"


def es(td: str) -> str:
    return f"6.11*exp(17.1*({td})/(234.2+({td})))"


def wet_bulb(t: str, rh: str) -> str:
    return (f"({t}*atan(0.151977*sqrt({rh}+8.313659)) + atan({t}+{rh}) - atan({rh}-1.676331)"
            f" + 0.00391838*pow({rh},1.5)*atan(0.023101*{rh}) - 4.686035)")


def hiri(e: str, t: str, kt: str) -> str:
    return f"5.67e-8*pow(94 + 12.6*ln(100*({e})) - 13*({kt}) + 0.341*({t}+273.15), 4)"


def sun(source: str, name: str, offset: str) -> str:
    """Adds st (solar time), hs (altitude in radians), g0 and kt to rows with ts, lat, lon, ghi."""
    return f"""{name}_a AS (
  SELECT *, dayofyear(clock) AS dy, year(clock) - 1957 AS yy, radians(360*(dayofyear(clock)-81)/365) AS b
  FROM (SELECT *, ts - INTERVAL 1 HOUR + to_minutes(CAST(round(off*60) AS BIGINT)) AS clock
        FROM (SELECT *, {offset} AS off FROM {source}))),
{name}_b AS (
  SELECT *, (2*pi()/365.2422)*(dy - 0.5 - radians(lon)/(2*pi()) - (78.8946 + 0.2422*yy - trunc(yy/4))) AS w,
         hour(clock) + (9.87*sin(2*b) - 7.53*cos(b) - 1.5*sin(b) + 4*(lon - off*15))/60 + 0.5 AS st FROM {name}_a),
{name}_c AS (
  SELECT *, 0.0064979 + 0.405906*sin(w) + 0.0020054*sin(2*w) - 0.002988*sin(3*w)
         - 0.0132296*cos(w) + 0.0063809*cos(2*w) + 0.0003508*cos(3*w) AS decl FROM {name}_b),
{name}_d AS (
  SELECT *, asin(sin(radians(lat))*sin(decl) + cos(radians(lat))*cos(decl)*cos(radians((st-12)*15))) AS hs FROM {name}_c),
{name}_e AS (
  SELECT *, CASE WHEN hs >= 0 THEN 1366*(1 + 0.0334*cos(dy*2*pi()/365.25 - 0.048869))*sin(hs) ELSE 0 END AS g0 FROM {name}_d),
{name} AS (
  SELECT *, CASE WHEN hs < 0 THEN 0 WHEN ghi/nullif(g0,0) > 0.8 THEN 0.8 ELSE ghi/nullif(g0,0) END AS kt FROM {name}_e)"""


ZONE_OFFSET = "date_diff('minute', ts, timezone(tz, timezone('UTC', ts)))/60"


def brl(source: str, name: str) -> str:
    """Adds kt_d, dif and dni to the rows of :func:`sun`."""
    return f"""{name}_a AS (
  SELECT *, coalesce(sum(ghi) OVER d, 0)/nullif(sum(g0) OVER d, 0) AS kt_d, lag(kt) OVER o AS k0, lead(kt) OVER o AS k2,
         row_number() OVER o AS n, count(*) OVER (PARTITION BY station_id) AS total
  FROM {source} WINDOW d AS (PARTITION BY station_id, CAST(clock AS DATE)), o AS (PARTITION BY station_id ORDER BY ts)),
{name}_b AS (
  SELECT *, CASE WHEN k0 = 0 AND kt <> 0 AND k2 <> 0 THEN k2 WHEN k0 <> 0 AND kt <> 0 AND k2 = 0 THEN k0
                 ELSE (k0+k2)/2 END AS psi FROM {name}_a),
{name}_c AS (
  SELECT *, CASE WHEN n = 1 OR n = total THEN NULL WHEN ghi = 0 THEN 0
    ELSE ghi/(1 + exp(-5.38 + 6.63*kt + 0.006*st - 0.007*degrees(hs) + 1.75*kt_d + 1.31*psi)) END AS dif FROM {name}_b),
{name} AS (
  SELECT *, CASE WHEN dif IS NULL THEN NULL WHEN ghi = 0 THEN 0 WHEN (ghi-dif)/nullif(sin(hs),0) < 0 THEN 0
    WHEN (ghi-dif)/nullif(sin(hs),0) > 1366 THEN 1366 ELSE (ghi-dif)/nullif(sin(hs),0) END AS dni FROM {name}_c)"""


def fs(source: str, name: str, whole: bool) -> str:
    """Finkelstein-Schafer statistics per station, year and month."""
    parts = []
    for v in ("t_db", "ghi", "rh", "v_air"):
        parts.append(
            f"abs(row_number() OVER (PARTITION BY station_id, y, m ORDER BY round({v}, 9), day)/count(*) OVER (PARTITION BY station_id, y, m)"
            f" - row_number() OVER (PARTITION BY station_id, m ORDER BY round({v}, 9), day)/count(*) OVER (PARTITION BY station_id, m)) AS d_{v}")
    keep = "WHERE days = day(last_day(day))" if whole else ""
    return f"""{name}_rows AS (
  SELECT * FROM (SELECT *, year(day) AS y, month(day) AS m,
    count(*) OVER (PARTITION BY station_id, year(day), month(day)) AS days FROM {source}) {keep}),
{name}_ranked AS (SELECT *, {', '.join(parts)} FROM {name}_rows),
{name} AS (SELECT station_id, y, m, sum(d_t_db) AS fs_t_db, sum(d_ghi) AS fs_ghi, sum(d_rh) AS fs_rh,
    sum(d_v_air) AS fs_v_air, avg(v_air) AS wind FROM {name}_ranked GROUP BY 1, 2, 3)"""


def chosen(source: str, name: str) -> str:
    return f"""{name}_three AS (
  SELECT * FROM (SELECT *, fs_t_db + fs_ghi + fs_rh AS fs_tot,
    row_number() OVER (PARTITION BY station_id, m ORDER BY round(fs_t_db + fs_ghi + fs_rh, 9), y) AS rk FROM {source}) WHERE rk <= 3),
{name} AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY station_id, m ORDER BY gap, rk) AS pick
    FROM (SELECT *, round(abs(wind - avg(wind) OVER (PARTITION BY station_id, m)), 9) AS gap FROM {name}_three)) WHERE pick = 1)"""


ISO_ROWS = f"""iso_rows AS (
  SELECT f.station_id, {in_1970('f.day')} AS tmy_ts, t_db, ghi, rh, v_air
  FROM flag f JOIN best b ON f.station_id = b.station_id AND year(f.day) = b.y AND month(f.day) = b.m
  WHERE {not_leap('f.day')})"""
ISO = [FLAG, fs("flag", "stat", True), chosen("stat", "best"), ISO_ROWS]


def mode_of(source: str, keys: str, column: str, name: str, condition: str = "TRUE") -> str:
    return f"""{name} AS (
  SELECT {keys}, {column} AS top FROM (
    SELECT {keys}, {column}, row_number() OVER (PARTITION BY {keys} ORDER BY count(*) DESC, {column}) AS rk
    FROM {source} WHERE {column} IS NOT NULL AND {condition} GROUP BY {keys}, {column}) WHERE rk = 1)"""


SEASON = """CASE WHEN month(day) IN (3,4,5) THEN 'spring' WHEN month(day) IN (6,7,8) THEN 'summer'
  WHEN month(day) IN (9,10,11) THEN 'autumn' ELSE 'winter' END"""


def weeks(source: str, name: str) -> str:
    return f"""{name}_rows AS (SELECT station_id, year(day) AS y, {SEASON} AS season, day, t_db, month(day) = 12 AS december FROM {source}),
{name}_roll AS (
  SELECT *, max(t_db) OVER s AS hi, min(t_db) OVER s AS lo, avg(t_db) OVER s AS mean, avg(t_db) OVER w AS week, count(*) OVER w AS n
  FROM {name}_rows WINDOW s AS (PARTITION BY station_id, y, season),
    w AS (PARTITION BY station_id, y, season, december ORDER BY day RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)),
{name}_full AS (SELECT *, round(abs(week - mean), 9) AS d_typical,
    round(abs(week - CASE season WHEN 'summer' THEN hi WHEN 'winter' THEN lo END), 9) AS d_extreme FROM {name}_roll WHERE n = 7),
{name}_typical AS (SELECT station_id, y, season, day FROM (
    SELECT *, row_number() OVER (PARTITION BY station_id, y, season ORDER BY d_typical, day) AS rk FROM {name}_full) WHERE rk = 1),
{name}_extreme AS (SELECT station_id, y, season, day FROM (
    SELECT *, row_number() OVER (PARTITION BY station_id, y, season ORDER BY d_extreme, day) AS rk FROM {name}_full
    WHERE d_extreme IS NOT NULL) WHERE rk = 1)"""


def soil_params(source: str, name: str, keys: str) -> str:
    return f"""{name}_day AS (SELECT *, dayofyear(day) - 1 AS d0 FROM {source}),
{name} AS (
  SELECT {keys}, 0.5*(avg(t_db) FILTER (month(day) = 7) - avg(t_db) FILTER (month(day) = 1)) + 1.1 AS amplitude,
         avg(t_db) + 1.7 AS mean_t, min(cold) AS cold, min(warm) AS warm,
         CASE WHEN min(cold) + 46 <= 364 THEN min(cold) + 46 ELSE min(cold) + 46 - 365 END AS phase_day
  FROM (SELECT *, first_value(d0) OVER (PARTITION BY {keys} ORDER BY round(ghi, 9), day) AS cold,
               first_value(d0*24) OVER (PARTITION BY {keys} ORDER BY t_db DESC, d0) AS warm FROM {name}_day)
  GROUP BY {keys})"""


def soil_params_of_hours(source: str, name: str) -> str:
    """Parameters of hourly rows by station and year: the phase from daily means, the warmest hour from the rows."""
    return f"""{name}_day AS (SELECT station_id, year, dayofyear(ts) - 1 AS d0, avg(ghi) AS light FROM {source} GROUP BY 1, 2, 3),
{name}_cold AS (SELECT DISTINCT station_id, year, first_value(d0) OVER (PARTITION BY station_id, year ORDER BY round(light, 9), d0) AS cold FROM {name}_day WHERE light IS NOT NULL),
{name}_warm AS (SELECT DISTINCT station_id, year, first_value(h) OVER (PARTITION BY station_id, year ORDER BY t_db DESC, h) AS warm
  FROM (SELECT station_id, year, t_db, (dayofyear(ts) - 1)*24 + hour(ts) AS h FROM {source} WHERE t_db IS NOT NULL)),
{name} AS (
  SELECT station_id, year, 0.5*(avg(t_db) FILTER (month(ts) = 7) - avg(t_db) FILTER (month(ts) = 1)) + 1.1 AS amplitude, avg(t_db) + 1.7 AS mean_t,
         min(warm) AS warm, CASE WHEN min(cold) + 46 <= 364 THEN min(cold) + 46 ELSE min(cold) + 46 - 365 END AS phase_day
  FROM {source} LEFT JOIN {name}_cold USING (station_id, year) LEFT JOIN {name}_warm USING (station_id, year) GROUP BY 1, 2)"""


def labs(t: str, phase: str, depth: str, alpha: str, period: str) -> str:
    return (f"mean_t - amplitude*exp(-({depth})*sqrt(pi()/({period}*({alpha}))))"
            f"*cos((2*pi()/{period})*({t} - {phase} - (({depth})/2)*sqrt({period}/(pi()*({alpha})))))")


SOILS = "soils(soil, alpha) AS (VALUES ('wet_clay', 6.177e-7), ('dry_clay', 4.891e-7), ('limestone', 1.907e-7), ('sand', 4.944e-7))"
MONTHS = "months AS (SELECT m AS month, dayofyear(make_date(1970, m, 15)) - 1 AS d FROM (SELECT unnest(range(1, 13)) AS m))"


def degree_hours(t: dict[str, str], thresholds: list[int], heating: bool, source: str) -> str:
    def total(expr: str) -> str:
        distance = f"th - {expr}" if heating else f"{expr} - th"
        return f"sum(greatest({distance}, 0))"
    columns = ", ".join(r(total(e), n) for n, e in t.items())
    return (f"SELECT station_id, {i('year')}, {i('th', 'threshold')}, {columns} FROM {source}, "
            f"(SELECT unnest([{', '.join(map(str, thresholds))}]) AS th) GROUP BY station_id, year, th")


def degree_days(value: str) -> str:
    return q([SUP, "years AS (SELECT unnest(range(1995, 2002)) AS y)"], f"""
SELECT s.station_id, {i('s.y', 'year')}, {r('coalesce(sum(v), 0)', 'degree_days')}
FROM (SELECT DISTINCT station_id, y FROM sup, years) s
LEFT JOIN (SELECT station_id, year(day) AS y, {value} AS v FROM sup WHERE {not_leap('day')}) d
  ON s.station_id = d.station_id AND s.y = d.y GROUP BY 1, 2""")


LAYERS = [("0.04", "t_db*0.9 + 1.3"), ("0.18", "t_db*0.7 + 3.1"), ("0.64", "t_db*0.5 + 5.7"), ("1.77", "t_db*0.3 + 9.1")]


def ground_lines(source: str, name: str) -> str:
    means = ", ".join(f"round(avg({e}), 2) + 0.0 AS s{n}" for n, (_, e) in enumerate(LAYERS))
    text = " || ".join(f"',{d},,,,' || string_agg(CAST(s{n} AS VARCHAR), ',' ORDER BY m)" for n, (d, _) in enumerate(LAYERS))
    return f"""{name}_m AS (SELECT station_id, year(day) AS y, month(day) AS m, {means} FROM {source} GROUP BY 1, 2, 3),
{name} AS (SELECT station_id, y, 'GROUND TEMPERATURES,4' || {text} AS line FROM {name}_m GROUP BY 1, 2)"""


MEAN_YEAR = [LINE_HOURS, filled("full_hours", "hours", HOUR_FIELDS, *ALL_YEARS),
             f"""stamped AS (SELECT *, (p_atm_min + p_atm_max)/2 AS p_atm, {in_1970('ts')} AS tmy_ts FROM full_hours WHERE {not_leap('ts')})""",
             mode_of("stamped", "station_id, tmy_ts", "wind_dir", "wind"),
             """mean_year AS (SELECT s.station_id, s.tmy_ts AS ts, avg(t_db) AS t_db, avg(rh) AS rh, avg(v_air) AS v_air, avg(rain) AS rain,
    avg(prec_rate) AS prec_rate, avg(ghi) AS ghi, avg(p_atm) AS p_atm, min(w.top) AS wind_dir
  FROM stamped s LEFT JOIN wind w USING (station_id, tmy_ts) GROUP BY 1, 2)"""]
DERIVED = [*MEAN_YEAR, FLAG_PLACES,
           """typed AS (SELECT m.*, lat, lon, tz, CASE WHEN rain = 0 THEN 40 WHEN prec_rate < 0.5 THEN 51 WHEN prec_rate <= 1 THEN 53
    WHEN prec_rate <= 2.5 THEN 61 ELSE 63 END AS kind FROM mean_year m JOIN flag_places USING (station_id))""",
           sun("typed", "lit", ZONE_OFFSET), brl("lit", "divided")]


def line_dates(kind: str, season: str) -> str:
    c = f"max(CASE WHEN season = '{season}' THEN {kind} END)"
    return (f"strftime({c} - INTERVAL 6 DAY, '%-m/%-d') || ',' || strftime({c}, '%-m/%-d')")


HEADER = [*MEAN_YEAR, FLAG_PLACES,
          "header_days AS (SELECT station_id, CAST(ts AS DATE) AS day, avg(t_db) AS t_db FROM mean_year GROUP BY 1, 2)",
          weeks("header_days", "wk"),
          f"""week_lines AS (SELECT station_id,
    'TYPICAL/EXTREME PERIODS,6,Summer - Week Nearest Max Temperature For Period,Extreme,' || {line_dates('e', 'summer')}
    || ',Summer - Week Nearest Average Temperature For Period,Typical,' || {line_dates('t', 'summer')}
    || ',Winter - Week Nearest Min Temperature For Period,Extreme,' || {line_dates('e', 'winter')}
    || ',Winter - Week Nearest Average Temperature For Period,Typical,' || {line_dates('t', 'winter')}
    || ',Autumn - Week Nearest Average Temperature For Period,Typical,' || {line_dates('t', 'autumn')}
    || ',Spring - Week Nearest Average Temperature For Period,Typical,' || {line_dates('t', 'spring')} AS line
  FROM (SELECT a.station_id, a.y, a.season, a.day AS t, b.day AS e FROM wk_typical a LEFT JOIN wk_extreme b USING (station_id, y, season))
  GROUP BY 1)""",
          "soil_hours AS (SELECT station_id, ts AS day, t_db FROM mean_year)", ground_lines("soil_hours", "gl"),
          f"""refs AS (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY round(d, 9), wmo) AS rk FROM (
    SELECT station_id, p.lat, p.lon, lpad(CAST(n_nationkey AS VARCHAR), 6, '0') AS wmo, n_name, n_nationkey,
      {km('p.lat', 'p.lon', '(35 + n_nationkey)', '(-9.5 + 1.1*n_nationkey)')} AS d FROM flag_places p, nation))""",
          """spans AS (SELECT station_id, min(CAST(ts AS DATE)) AS a, max(CAST(ts AS DATE)) AS b FROM mean_year GROUP BY 1)"""]


def header_line(n: int, text: str) -> str:
    return f"SELECT station_id, CAST({n} AS BIGINT) AS line_no, {text} AS line FROM head"


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}

    sql["q_range_filter"] = q([POINTS], """
SELECT station_id, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts FROM pts
WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-20 12:00:00' AND field IN ('t_db', 'rh') GROUP BY 1""")
    sql["q_json_flatten"] = f"""
SELECT 'U' || user_id AS station_id, date_trunc('second', ts) AS ts, count(*) AS n,
  {r("sum(CAST(json_extract_string(props, '$.k') AS DOUBLE))", 'rh')}, {r('sum(value)', 't_db')},
  {r('sum(value*2/3.6)', 'v_air')}, CAST(0 AS BIGINT) AS n_ghi FROM events GROUP BY 1, 2"""
    sql["q_unpivot"] = q([FLAG], "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT station_id, day, '{f}' AS field, {r(f, 'value')} FROM flag" + (" WHERE rh <= 72" if f == "v_air" else "")
        for f in ("t_db", "ghi", "rh", "v_air")) + ")")
    sql["q_unit_convert"] = q([SUP], f"""SELECT station_id, day, {r('v_air/3.6', 'v_ms')},
  {r('100*coalesce(CASE WHEN rh > 60 THEN 1000 + v_air END, (990 + t_db + 995 + rh)/2)', 'p_pa')} FROM sup""")
    sql["q_coords"] = f"""
SELECT user_id AS station_id, {r('arg_max(40 + event_id % 97 / 8, (ts, 40 + event_id % 97 / 8, -7 + event_id % 89 / 4))', 'lat')},
  {r('arg_max(-7 + event_id % 89 / 4, (ts, 40 + event_id % 97 / 8, -7 + event_id % 89 / 4))', 'lon')} FROM events GROUP BY 1"""
    sql["q_id_list"] = """
SELECT id, count(*) AS n FROM (SELECT upper(trim(c_name)) AS id FROM customer UNION ALL SELECT upper(trim(c_mktsegment)) FROM customer
  UNION ALL SELECT 'N' || c_nationkey FROM customer) GROUP BY 1"""
    sql["q_upsert_latest"] = q([POINTS], f"""
SELECT station_id, field, date_trunc('hour', ts) AS hour_ts, {r('arg_max(value, event_id)', 'value')} FROM pts GROUP BY 1, 2, 3""")

    sql["q_point_store"] = q([POINTS, PLACES], f"""
SELECT station_id, field, count(*) AS n, {r('sum(value)', 'total')}, {r('max(lat)', 'lat')}
FROM (SELECT 'u' || station_id AS station_id, field, ts, max(value) + CASE field WHEN 't_db' THEN 0.5 ELSE 0 END AS value, lat
      FROM pts JOIN places USING (station_id)
      WHERE ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-29' GROUP BY station_id, field, ts, lat) GROUP BY 1, 2""")
    sql["q_hourly_mean"] = q([POINTS], f"""
SELECT station_id, field, {END} AS hour_end, {r('avg(value)', 'mean')} FROM pts GROUP BY 1, 2, 3""")
    five = ["t_db", "rh", "v_air", "p_atm", "ghi"]
    sql["q_hourly_pivot"] = q([POINTS, wide("w", five)],
                              f"SELECT station_id, ts AS hour_end, {', '.join(r(f) for f in five)} FROM w")
    sql["q_hourly_multi_agg"] = q(
        ["""lines AS (SELECT l_returnflag AS station_id, date_trunc('hour', l_shipdate + to_hours(CAST((l_orderkey + 5*l_linenumber) % 24 AS INTEGER))) AS hour_ts, l_quantity, l_tax,
  floor((l_extendedprice % 360 + 22.5)/45)*45 AS sector, floor(l_discount*30) AS kind FROM lineitem)""",
         mode_of("lines", "station_id, hour_ts", "sector", "m1"),
         mode_of("lines", "station_id, hour_ts", "kind", "m2", "kind <> 0")], f"""
SELECT a.station_id, a.hour_ts, {r('avg(l_quantity*pi())', 't_db')}, {r('sum(l_tax*100)', 'rain')},
  {r('min(m1.top)', 'wind_dir')}, {r('coalesce(min(m2.top), 0)', 'rain_type')}
FROM lines a LEFT JOIN m1 USING (station_id, hour_ts) LEFT JOIN m2 USING (station_id, hour_ts) GROUP BY 1, 2""")
    sql["q_daily_mean"] = q([POINTS, wide("w", ["t_db", "rh"], "date_trunc('hour', ts)")], f"""
SELECT station_id, CAST(ts AS DATE) AS day, {r('avg(t_db)', 't_db')}, {r('avg(rh)', 'rh')} FROM w GROUP BY 1, 2""")
    sql["q_monthly_mean"] = q([SUP], f"""
SELECT station_id, {i('year(day)', 'year')}, {i('month(day)', 'month')}, {r('avg(t_db)', 't_db')}, {r('avg(ghi)', 'ghi')}
FROM sup GROUP BY station_id, year(day), month(day)""")
    sql["q_temp_trend"] = q([SUP], f"""
SELECT s.station_id, {i('s.y', 'year')}, {r('avg(t_db)', 't_db')}
FROM (SELECT DISTINCT station_id, y FROM sup, (SELECT unnest(range(1994, 2002)) AS y)) s
LEFT JOIN sup ON sup.station_id = s.station_id AND year(day) = s.y GROUP BY 1, 2""")
    sql["q_mode"] = q(
        ["vals AS (SELECT user_id AS station_id, floor(value/10) AS v FROM events)",
         mode_of("vals", "station_id", "v", "m1"), mode_of("vals", "station_id", "v", "m2", "v <> 0")], f"""
SELECT station_id, {r('m1.top', 'mode_std')}, {r('coalesce(m2.top, 0)', 'mode_zero')} FROM m1 LEFT JOIN m2 USING (station_id)""")

    sql["q_gapfill_same_hour"] = q([POINTS, wide("w", ["t_db"]), filled("f", "w", ["t_db"], *JANUARY)],
                                   f"SELECT station_id, ts, {r('t_db')} FROM f")
    sql["q_gapfill_window_mean"] = q([POINTS, wide("w", five)], f"""
SELECT station_id, ts, {r('coalesce(ghi, near)', 'ghi')} FROM (SELECT *, avg(ghi) OVER (PARTITION BY station_id, hour(ts) ORDER BY ts
  RANGE BETWEEN INTERVAL 72 HOUR PRECEDING AND INTERVAL 72 HOUR FOLLOWING) AS near FROM w)""")

    def interpolated(column: str, position: str, source: str, out: str) -> str:
        return f"""
SELECT station_id, {out}, {r(f'CASE WHEN {column} IS NOT NULL THEN {column} WHEN ni IS NULL THEN pv ELSE pv + (nv-pv)*(pos-pi)/(ni-pi) END', column)}
FROM (SELECT *, last_value(CASE WHEN {column} IS NOT NULL THEN pos END IGNORE NULLS) OVER up AS pi,
        last_value({column} IGNORE NULLS) OVER up AS pv,
        first_value(CASE WHEN {column} IS NOT NULL THEN pos END IGNORE NULLS) OVER down AS ni,
        first_value({column} IGNORE NULLS) OVER down AS nv
      FROM (SELECT *, {position} AS pos FROM {source})
      WINDOW up AS (PARTITION BY station_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
             down AS (PARTITION BY station_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""

    sql["q_interpolate"] = q([POINTS, wide("w", five)],
                             interpolated("rh", "date_diff('hour', TIMESTAMP '1970-01-01', ts)", "w", "ts"))
    sql["q_interpolate_daily"] = q(
        [SUP, "gaps AS (SELECT station_id, day, CASE WHEN rh < 80 THEN t_db END AS t_db FROM sup)"],
        interpolated("t_db", "date_diff('day', DATE '1970-01-01', day)", "gaps", "day"))

    sql["q_hdd"] = degree_days("CASE WHEN t_db <= 15 THEN 18 - t_db END")
    sql["q_cdd"] = degree_days("CASE WHEN t_db >= 24 THEN t_db - 21 END")
    sql["q_hdh"] = q(SUP_HOURS, degree_hours({"degree_hours": "t_db"}, [18, 20, 22], True, "suph"))
    sql["q_cdh"] = q(SUP_HOURS, degree_hours({"degree_hours": "t_db"}, [18, 21, 24, 26, 28], False, "suph"))
    soil = labs("((dayofyear(ts)-1)*24 + hour(ts))", "phase_day*24", "2.5", "6.177e-7*3600", "8760.0")
    sql["q_cdh_eahx"] = q(
        [*SUP_HOURS, soil_params_of_hours("suph", "par"),
         f"treated AS (SELECT station_id, year, t_db, t_db - 0.8*(t_db - ({soil})) AS tt FROM suph JOIN par USING (station_id, year))"],
        degree_hours({"baseline": "t_db", "residual": "tt"}, [18, 21, 24, 26], False, "treated"))
    sql["q_cdh_pdec"] = q(
        [*SUP_HOURS, f"treated AS (SELECT station_id, year, t_db, t_db - 0.8*(t_db - {wet_bulb('t_db', 'rh')}) AS tt FROM suph)"],
        degree_hours({"baseline": "t_db", "residual": "tt"}, [18, 21, 24, 26], False, "treated"))

    sql["q_tmy_iso_fs"] = q([FLAG, fs("flag", "stat", True)], f"""
SELECT station_id, {i('y', 'year')}, {i('m', 'month')}, {r('fs_t_db')}, {r('fs_ghi')}, {r('fs_rh')}, {r('fs_v_air')} FROM stat""")
    sql["q_tmy_iso"] = q(ISO[:3], f"""
SELECT station_id, {i('m', 'month')}, {i('y', 'chosen_year')}, {r('fs_tot')} FROM best""")
    sql["q_tmy_iso_network"] = q([SUP, fs("sup", "stat", False), chosen("stat", "best")], f"""
SELECT station_id, {i('m', 'month')}, {i('y', 'chosen_year')}, {r('fs_tot')} FROM best""")
    def term(v: str) -> str:
        one, every = (f"row_number() OVER (PARTITION BY {g} ORDER BY round({v}, 9) NULLS LAST, day)/count({v}) OVER (PARTITION BY {g})"
                      for g in ("station_id, y, m", "station_id, m"))
        return f"CASE WHEN {v} IS NOT NULL THEN abs({one} - {every}) END AS d_{v}"

    sql["q_tmy_iso_absent"] = q([SUP, f"""gaps AS (SELECT station_id, day, year(day) AS y, month(day) AS m, t_db,
    CASE WHEN station_id % 3 <> 0 THEN ghi END AS ghi, CASE WHEN station_id % 2 = 1 OR day(day) % 5 <> 0 THEN rh END AS rh,
    CASE WHEN station_id % 4 <> 0 OR year(day) % 2 = 0 THEN v_air END AS v_air FROM sup)""",
        f"ranked AS (SELECT *, {', '.join(term(v) for v in ('t_db', 'ghi', 'rh'))} FROM gaps)",
        """stat AS (SELECT station_id, y, m, coalesce(sum(d_t_db), 0) + coalesce(sum(d_ghi), 0) + coalesce(sum(d_rh), 0) AS fs_tot,
    avg(v_air) AS wind FROM ranked GROUP BY 1, 2, 3)""",
        """three AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY station_id, m ORDER BY round(fs_tot, 9), y) AS rk FROM stat) WHERE rk <= 3)""",
        """best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY station_id, m ORDER BY gap NULLS LAST, rk) AS pick
    FROM (SELECT *, round(abs(wind - avg(wind) OVER (PARTITION BY station_id, m)), 9) AS gap FROM three)) WHERE pick = 1)"""], f"""
SELECT station_id, {i('m', 'month')}, {i('y', 'chosen_year')}, {r('fs_tot')} FROM best""")
    sql["q_gridded_hourly"] = q([LINE_HOURS], f"""
SELECT station_id, ts, {r('t_db')}, {r("CASE WHEN station_id <> 'N' THEN rh END", 'rh')}, {r("CASE WHEN station_id = 'N' THEN v_air END", 'v_air')}
FROM hours""")
    four = ", ".join(r(c) for c in ("t_db", "ghi", "rh", "v_air"))
    sql["q_tmy_iso_rows"] = q(ISO, f"SELECT station_id, tmy_ts, {four} FROM iso_rows")
    sql["q_tmy_csv_roundtrip"] = sql["q_tmy_iso_rows"]
    mean_days = [FLAG, f"""days AS (SELECT *, {in_1970('day')} AS tmy_ts, floor((ghi % 360 + 22.5)/45)*45 AS sector
  FROM flag WHERE {not_leap('day')})""", mode_of("days", "station_id, tmy_ts", "sector", "w")]
    sql["q_tmy_mean"] = q(mean_days, f"""
SELECT station_id, tmy_ts, {r('avg(t_db)', 't_db')}, {r('avg(ghi)', 'ghi')}, {r('avg(rh)', 'rh')}, {r('avg(v_air)', 'v_air')},
  {i('min(w.top)', 'wind_dir')} FROM days LEFT JOIN w USING (station_id, tmy_ts) GROUP BY 1, 2""")
    sql["q_tmy_iso_hourly"] = q(
        [LINE_HOURS, filled("full_hours", "hours", HOUR_FIELDS, *ALL_YEARS),
         "hour_days AS (SELECT station_id, CAST(ts AS DATE) AS day, avg(t_db) AS t_db, avg(ghi) AS ghi, avg(rh) AS rh, avg(v_air) AS v_air FROM full_hours GROUP BY 1, 2)",
         fs("hour_days", "stat", False), chosen("stat", "best")], f"""
SELECT f.station_id, {in_1970('f.ts')} AS tmy_ts, {four} FROM full_hours f
JOIN best b ON f.station_id = b.station_id AND year(f.ts) = b.y AND month(f.ts) = b.m WHERE {not_leap('f.ts')}""")
    sql["q_tmy_mean_hourly"] = q(MEAN_YEAR, f"""
SELECT station_id, ts AS tmy_ts, {', '.join(r(c) for c in ('t_db', 'rh', 'v_air', 'rain', 'prec_rate', 'ghi', 'p_atm', 'wind_dir'))}
FROM mean_year""")

    for kind in ("typical", "extreme"):
        sql[f"q_{kind}_week"] = q([FLAG, weeks("flag", "wk")], f"""
SELECT station_id, {i('y', 'year')}, season, CAST(day - INTERVAL 6 DAY AS DATE) AS week_start, day AS week_end FROM wk_{kind}""")
    sql["q_season_scalars"] = q([SUP], f"""
SELECT station_id, {i('year(day)', 'year')}, {SEASON} AS season, {r('max(t_db)', 't_max')}, {r('min(t_db)', 't_min')}, {r('avg(t_db)', 't_mean')}
FROM sup GROUP BY station_id, year(day), {SEASON}""")

    sql["q_rain_code"] = """
SELECT CAST(rain_type AS BIGINT) AS rain_type, CAST(total_type AS BIGINT) AS total_type, CAST(obs AS BIGINT) AS obs,
  CAST(CASE rain_type WHEN 51 THEN 993999999 WHEN 53 THEN 995999999 WHEN 61 THEN 909999999 WHEN 63 THEN 929999999
    ELSE CASE WHEN obs = 9 THEN 999999999 ELSE 0 END END AS BIGINT) AS code, count(*) AS n
FROM (SELECT *, CASE WHEN rain_type = 40 OR l_tax = 0 THEN 9 ELSE 0 END AS obs FROM (
  SELECT l_tax, CASE WHEN l_tax = 0 THEN 40 WHEN l_discount*30 < 0.5 THEN 51 WHEN l_discount*30 <= 1 THEN 53
    WHEN l_discount*30 <= 2.5 THEN 61 ELSE 63 END AS rain_type, CASE WHEN l_tax = 0 THEN 40 ELSE 61 END AS total_type FROM lineitem))
GROUP BY 1, 2, 3, 4"""
    sql["q_wind_sector"] = f"""
SELECT {i('floor((l_extendedprice % 360 + 22.5)/45)*45', 'sector')}, count(*) AS n FROM lineitem GROUP BY 1"""
    td = dew("t_db", "rh")
    sql["q_psychro"] = q([SUP], f"""
SELECT station_id, day, {r(td, 't_dp')}, {r(es(td), 'es')},
  {r('6.112*exp(17.67*t_db/(t_db+243.5))*rh*18.02/((273.15+t_db)*100*0.08314)', 'abs_hum')}, {r(wet_bulb('t_db', 'rh'), 't_wb')} FROM sup""")
    sql["q_hiri"] = q([SUP], f"SELECT station_id, day, {r(hiri(es(td), 't_db', 'ghi/700'), 'hiri')} FROM sup")
    lit_points = [POINTS, PLACES, wide("w", five),
                  "placed AS (SELECT w.station_id, w.ts, w.ghi, lat, lon, tz FROM w JOIN places USING (station_id))",
                  sun("placed", "lit", ZONE_OFFSET)]
    sql["q_solar"] = q(lit_points, f"""
SELECT station_id, ts, {r('hs', 'altitude')}, {r('g0')}, {r('kt')},
  {r('CASE WHEN hs >= 0 THEN (ghi - 0.3*ghi)/nullif(sin(hs), 0) ELSE 0 END', 'dni')} FROM lit""")
    january = [POINTS, PLACES, wide("w", ["ghi"]), filled("f", "w", ["ghi"], *JANUARY),
               "placed AS (SELECT f.station_id, f.ts, f.ghi, lat, lon, tz FROM f JOIN places USING (station_id))",
               sun("placed", "lit", ZONE_OFFSET)]
    sql["q_clearness_daily"] = q(january, f"""
SELECT station_id, CAST(clock AS DATE) AS day, {r('coalesce(sum(ghi), 0)/nullif(sum(g0), 0)', 'kt_d')} FROM lit GROUP BY 1, 2""")
    sql["q_brl_split"] = q([*january, brl("lit", "divided")],
                           f"SELECT station_id, ts, {r('kt_d')}, {r('dif')}, {r('dni')} FROM divided")
    sql["q_tz_offset"] = q([POINTS, PLACES, wide("w", five)], f"""
SELECT station_id, {r(ZONE_OFFSET, 'offset_h')}, count(*) AS n FROM w JOIN places USING (station_id) GROUP BY 1, 2""")

    sql["q_soil_params"] = q([SUP, "supy AS (SELECT *, year(day) AS year FROM sup)", soil_params("supy", "par", "station_id, year")], f"""
SELECT station_id, {i('year')}, {r('amplitude')}, {r('mean_t')}, {i('phase_day')} FROM par""")
    sql["q_soil_profile"] = q([SUP, "supy AS (SELECT *, year(day) AS year FROM sup)", soil_params("supy", "par", "station_id, year"), SOILS, MONTHS], f"""
SELECT station_id, {i('year')}, soil, {i('month')}, {r('depth')}, {r(labs('d', 'phase_day', 'depth', 'alpha*86400', '365.0'), 't_soil')}
FROM par, soils, months, (SELECT unnest([0.5, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0, 10.0])::DOUBLE AS depth)""")
    sql["q_soil_hadvig"] = q([*SUP_HOURS, soil_params_of_hours("suph", "par"), SOILS, MONTHS], f"""
SELECT station_id, {i('year')}, soil, {i('month')}, {r('depth')},
  {r('mean_t + amplitude*exp(-depth*sqrt(pi()/(alpha*31536000)))*cos((2*pi()/31536000)*(d*86400.0 + 43200 - warm*3600.0) - depth*sqrt(pi()/31536000))', 't_soil')}
FROM par, soils, months, (SELECT unnest([0.5, 2.0])::DOUBLE AS depth)""")
    sql["q_soil_daily"] = q([FLAG, soil_params("flag", "par", "station_id")], f"""
SELECT station_id, day, {i('depth')}, {r('t_db', 't_air')},
  {r(labs('(dayofyear(day)-1)', 'phase_day', 'depth', '6.177e-7*86400', '365.0'), 't_soil')}
FROM flag JOIN par USING (station_id), (SELECT unnest(range(1, 7)) AS depth)""")
    sql["q_ground_temps"] = q([FLAG, ground_lines("flag", "gl")], f"SELECT station_id, {i('y', 'year')}, line FROM gl")

    sql["q_nearest_station"] = q(
        [SUP_PLACES, """cust AS (SELECT c_custkey AS station_id, 34 + c_custkey%26 + c_acctbal/10000 AS lat,
  -12 + c_custkey%37 + c_acctbal/20000 AS lon FROM customer)"""], f"""
SELECT station_id, ref, {r('d', 'km')} FROM (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY round(d, 9), ref) AS rk FROM (
  SELECT c.station_id, s.station_id AS ref, {km('c.lat', 'c.lon', 's.lat', 's.lon')} AS d FROM cust c, sup_places s)) WHERE rk = 1""")

    def gap(series: str, places: str, part: str, name: str) -> str:
        zone = f"CASE WHEN {km('lat', 'lon', '50.0', '10.0', 6373.0)} <= 900 THEN 'urban' ELSE 'suburban' END"
        u, s = "avg(t_db) FILTER (zone = 'urban')", "avg(t_db) FILTER (zone = 'suburban')"
        return f"""SELECT {i(name)}, {r(u, 'urban')}, {r(s, 'suburban')}, {r(f'{u} - {s}', 'gap')}
FROM (SELECT {part} AS {name}, t_db, {zone} AS zone FROM {series} JOIN {places} USING (station_id)) GROUP BY {name}"""

    sql["q_uhi_gap_hour"] = q([POINTS, PLACES, wide("w", ["t_db"])], gap("w", "places", "hour(ts)", "hour"))
    sql["q_uhi_gap_month"] = q([SUP, SUP_PLACES], gap("sup", "sup_places", "month(day)", "month"))
    sql["q_uhi_daily_map"] = q([POINTS], """
SELECT station_id, CAST(ts AS DATE) AS day, round(round(avg(value), 9), 1) + 0.0 AS mean FROM pts WHERE field = 't_db' GROUP BY 1, 2""")
    sql["q_days_present"] = "SELECT DISTINCT CAST(ts AS DATE) AS day FROM events"

    dates = (f"{i('year(ts)', 'year')}, {i('month(ts)', 'month')}, {i('day(ts)', 'day')}, {i('hour(ts) + 1', 'hour')}, {i('1', 'minute')}")
    tdd = dew("t_db", "rh")
    sql["q_epw_rows"] = q(DERIVED, f"""
SELECT station_id, {dates}, {r('t_db', 'dry_bulb_temperature')}, {r(tdd, 'dew_point_temperature')},
  {i('trunc(round(rh, 6))', 'relative_humidity')}, {i('trunc(round(p_atm*100, 6))', 'atmospheric_station_pressure')},
  {r(hiri(es(tdd), 't_db', 'kt_d'), 'horizontal_infrared_radiation_intensity')}, {r('dni', 'direct_normal_radiation')},
  {r('dif', 'diffuse_horizontal_radiation')}, {i('floor((wind_dir + 22.5)/45)*45', 'wind_direction')}, {r('v_air', 'wind_speed')},
  {i('CASE WHEN kind = 40 OR rain = 0 THEN 9 ELSE 0 END', 'present_weather_observation')}, {r('rain', 'liquid_precipitation_depth')}
FROM divided""")
    sql["q_epw_roundtrip"] = q(DERIVED, f"""
SELECT station_id, ts, {r('t_db', 'dry_bulb_temperature')}, {r('v_air', 'wind_speed')} FROM divided""")
    nothing = ("CAST(NULL AS DOUBLE) AS dry_bulb_temperature, CAST(NULL AS BIGINT) AS relative_humidity, "
               "CAST(NULL AS BIGINT) AS atmospheric_station_pressure, CAST(NULL AS DOUBLE) AS wind_speed, "
               "CAST(NULL AS BIGINT) AS present_weather_observation")
    sql["q_epw_pad"] = q([POINTS, wide("w", five, "date_trunc('hour', ts)")], f"""
SELECT station_id, {dates}, {r('t_db', 'dry_bulb_temperature')}, {i('trunc(round(rh, 6))', 'relative_humidity')},
  {i('trunc(round(p_atm*100, 6))', 'atmospheric_station_pressure')}, {r('v_air', 'wind_speed')}, {i('9', 'present_weather_observation')} FROM w
UNION ALL
SELECT station_id, {dates}, {nothing} FROM (
  SELECT station_id, unnest(generate_series(date_trunc('day', min(ts)), min(ts) - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS ts FROM w GROUP BY 1)""")
    head = """head AS (SELECT r.*, week_lines.line AS weeks, gl.line AS ground, a, b FROM refs r JOIN week_lines USING (station_id)
  JOIN gl USING (station_id) JOIN spans USING (station_id) WHERE rk = 1)"""
    sql["q_epw_header"] = q([*HEADER, head], " UNION ALL ".join([
        header_line(1, "'LOCATION,' || n_name || ',,ITA,network,' || wmo || ',' || CAST(round(lat, 2) AS VARCHAR) || ',' "
                       "|| CAST(round(lon, 2) AS VARCHAR) || ',' || (n_nationkey % 3) || ',240'"),
        header_line(2, "'DESIGN CONDITIONS,1,' || n_name"),
        header_line(3, "weeks"),
        header_line(4, "ground"),
        header_line(5, "'HOLIDAYS/DAYLIGHT SAVINGS,No,0,0,0'"),
        header_line(6, "'COMMENTS 1,averaged year'"),
        header_line(7, "'COMMENTS 2,'"),
        header_line(8, "'DATA PERIODS,1,1,Data,Monday,' || strftime(a, '%-m/%-d/%Y') || ',' || strftime(b, '%-m/%-d/%Y')"),
    ]))
    sql["q_gridded_csv"] = q([FLAG, FLAG_PLACES], f"""
SELECT {r('round(lat, 2)', 'lat')}, {r('round(lon, 2)', 'lon')}, day, {r('t_db')} FROM flag JOIN flag_places USING (station_id)""")

    customers = """cust AS (SELECT c_custkey AS station_id, 34 + c_custkey%26 + c_acctbal/10000 AS lat, -12 + c_custkey%37 + c_acctbal/20000 AS lon FROM customer)"""
    sql["q_nearest_two_sources"] = q([SUP_PLACES, customers, "both_ AS (SELECT 'a' AS source, station_id, lat, lon FROM sup_places UNION ALL SELECT 'b', station_id, lat, lon FROM cust)"], f"""
SELECT source, station_id, wmo, {r('d', 'km')} FROM (SELECT *, row_number() OVER (PARTITION BY source, station_id ORDER BY round(d, 9), wmo) AS rk FROM (
  SELECT s.source, s.station_id, lpad(CAST(n_nationkey AS VARCHAR), 6, '0') AS wmo, {km('s.lat', 's.lon', '(35.0 + n_nationkey)', '(-9.5 + 1.1*n_nationkey)')} AS d FROM both_ s, nation)) WHERE rk = 1""")
    sql["q_zone_of_place"] = q([customers, """middle AS (SELECT n_name AS zone, n_nationkey AS n, 36 + 3*(n_nationkey % 8) + 0.123::DOUBLE AS y,
  -10 + 8*floor(n_nationkey/8) + n_nationkey % 3 + 0.321::DOUBLE AS x FROM nation)""", """corners AS (
  SELECT zone, 0 AS ring, seq, x + (2.5 + 1.3*cos(5*seq + n))*cos(2*pi()*seq/12) AS lon, y + (2.5 + 1.3*cos(5*seq + n))*sin(2*pi()*seq/12) AS lat
  FROM middle, (SELECT unnest(range(0, 12)) AS seq)
  UNION ALL
  SELECT zone, 1, seq, x + 0.9*cos(2*pi()*seq/3), y + 0.9*sin(2*pi()*seq/3) FROM middle, (SELECT unnest(range(0, 3)) AS seq) WHERE n % 3 = 0)""", """sides AS (
  SELECT zone, lon AS x1, lat AS y1, coalesce(lead(lon) OVER w, first_value(lon) OVER w) AS x2, coalesce(lead(lat) OVER w, first_value(lat) OVER w) AS y2
  FROM corners WINDOW w AS (PARTITION BY zone, ring ORDER BY seq))""", """inside AS (
  SELECT station_id, zone FROM cust, sides WHERE (y1 > lat) <> (y2 > lat) AND lon < x1 + (lat - y1)*(x2 - x1)/(y2 - y1)
  GROUP BY station_id, zone HAVING count(*) % 2 = 1)"""], """
SELECT station_id, min(zone) AS zone FROM cust LEFT JOIN inside USING (station_id) GROUP BY 1""")
    u, v = "sum(t_db) FILTER (d <= radius)", "sum(t_db) FILTER (d > radius)"
    nu, nv = "count(t_db) FILTER (d <= radius)", "count(t_db) FILTER (d > radius)"
    sql["q_uhi_many_centres"] = q([SUP, SUP_PLACES, f"""met AS (SELECT n_name AS circle, station_id, 100 + 60*n_nationkey AS radius, {km('lat', 'lon', '(35.0 + n_nationkey)', '(-9.5 + 1.1*n_nationkey)', 6373.0)} AS d
  FROM sup_places, nation)"""], f"""
SELECT circle, {i('month(day)', 'month')}, {r(f'{u}/{nu}', 'urban')}, {r(f'{v}/nullif({nv}, 0)', 'suburban')}, {r(f'{u}/{nu} - {v}/nullif({nv}, 0)', 'gap')}
FROM sup JOIN met USING (station_id) GROUP BY circle, month(day) HAVING {nu} > 0""")
    sql["q_elevation"] = q([customers, "nodes AS (SELECT p_partkey % 120 AS i, p_partkey // 120 AS j, p_retailprice/pi() AS h FROM part)",
                            "places AS (SELECT *, (lon + 15)/0.5 AS x, (lat - 33)/0.5 AS y FROM cust)",
                            """near AS (SELECT station_id, floor(x) + a AS i, floor(y) + b AS j,
  (CASE a WHEN 1 THEN x - floor(x) ELSE 1 - (x - floor(x)) END)*(CASE b WHEN 1 THEN y - floor(y) ELSE 1 - (y - floor(y)) END) AS w
  FROM places, (SELECT unnest([0, 1]) AS a), (SELECT unnest([0, 1]) AS b))"""], f"""
SELECT station_id, {r('CASE WHEN count(h) = count(*) THEN sum(h*w) END', 'elevation')} FROM near LEFT JOIN nodes ON nodes.i = near.i AND nodes.j = near.j WHERE w > 0 GROUP BY 1""")
    sql["q_hourly_found"] = q([LINE_HOURS, f"""bright AS (
  SELECT l_returnflag AS station_id, date_trunc('hour', l_shipdate + to_hours(CAST((l_orderkey + 5*l_linenumber) % 24 AS INTEGER))) AS ts, 'Bright_' || l_linestatus AS field,
         avg(l_extendedprice/(63*pi())) AS value FROM lineitem GROUP BY 1, 2, 3)"""], f"""
SELECT station_id, b.ts, {r('t_db')}, field, {r('value')} FROM bright b JOIN (SELECT station_id, ts - INTERVAL 1 HOUR AS ts, t_db FROM hours) USING (station_id, ts)""")
    wb = wet_bulb("t_db", "rh")
    kinds = [("heating", "t_db", "v_air", (0.004, 0.01), "ASC"), ("humidification", "t_dp", "t_db", (0.004, 0.01), "ASC"), ("enthalpy", "h", "t_db", (0.004, 0.01, 0.02), "DESC"), ("cooling", "t_db", "t_wb", (0.004, 0.01, 0.02), "DESC"), ("evaporation", "t_wb", "t_db", (0.004, 0.01, 0.02), "DESC"),
             ("dehumidification", "t_dp", "t_db", (0.004, 0.01, 0.02), "DESC"), ("wind", "v_air", "t_db", (0.01, 0.025, 0.05), "DESC")]
    design = " UNION ALL ".join(f"""
SELECT d.station_id, '{kind}' AS kind, share, {r('d.x', 'value')}, {r(f'avg(h.{other})', 'mean')} FROM (
  SELECT station_id, share, {x} AS x, row_number() OVER (PARTITION BY station_id, share ORDER BY {x} {way}) AS rk, count(*) OVER (PARTITION BY station_id, share) AS n
  FROM wet, (SELECT unnest({list(shares)})::DOUBLE AS share) WHERE {x} IS NOT NULL) d
JOIN wet h ON h.station_id = d.station_id AND abs(h.{x} - d.x) <= 0.5
WHERE rk = floor(n*share) + 1 GROUP BY d.station_id, share, d.x""" for kind, x, other, shares, way in kinds)
    sql["q_design_conditions"] = q([LINE_HOURS, f"moist AS (SELECT station_id, ts, t_db, rh, v_air, {wb} AS t_wb, {dew('t_db', 'rh')} AS t_dp FROM hours)",
                                    f"wet AS (SELECT *, 1.006*t_db + 0.62198*{es('t_dp')}/(1013.25 - {es('t_dp')})*(2501 + 1.86*t_db) AS h FROM moist)"], design)
    factors = {n: f"(-sqrt(6.0)/pi()*(0.5772 + ln(ln({n}/({n} - 1.0)))))" for n in (5, 10, 20, 50)}
    returns = ", ".join(f"{r(f'avg(low) - {f}*stddev_samp(low)', f'min_{n}')}, {r(f'avg(high) + {f}*stddev_samp(high)', f'max_{n}')}" for n, f in factors.items())
    sql["q_design_extremes"] = q([LINE_HOURS, """span AS (SELECT station_id, CAST(ts AS DATE) AS day, max(t_db) - min(t_db) AS span FROM hours GROUP BY 1, 2)""",
                                  """by_month AS (SELECT h.station_id, month(h.ts) AS m, round(avg(t_db), 9) AS mean FROM hours h GROUP BY 1, 2)""",
                                  """ends AS (SELECT station_id, (SELECT m FROM by_month b WHERE b.station_id = a.station_id ORDER BY mean, m LIMIT 1) AS cold,
  (SELECT m FROM by_month b WHERE b.station_id = a.station_id ORDER BY mean DESC, m LIMIT 1) AS hot FROM (SELECT DISTINCT station_id FROM by_month) a)""",
                                  "years AS (SELECT station_id, year(ts) AS y, min(t_db) AS low, max(t_db) AS high FROM hours GROUP BY 1, 2)"], f"""
SELECT station_id, {i('min(cold)', 'coldest_month')}, {i('min(hot)', 'hottest_month')},
  {r('(SELECT avg(span) FROM span s WHERE s.station_id = e.station_id AND month(s.day) = min(e.hot))', 'day_range')},
  {r('avg(low)', 'min_mean')}, {r('avg(high)', 'max_mean')}, {r('stddev_samp(low)', 'min_std')}, {r('stddev_samp(high)', 'max_std')}, {returns}
FROM ends e JOIN years USING (station_id) GROUP BY station_id""")
    sql["q_rollup_after_upsert"] = q([POINTS, """versions AS (
  SELECT station_id, ts, field, value, 2 AS stamp FROM pts WHERE event_id % 5 <> 0
  UNION ALL SELECT station_id, ts, field, value + 0.5, 3 FROM pts WHERE event_id % 5 <> 0 AND field = 't_db'
  UNION ALL SELECT station_id, ts, field, value, 1 FROM pts WHERE event_id % 5 = 0 OR event_id % 7 = 0)""", """last AS (
  SELECT station_id, ts, field, arg_max(value, (stamp, value)) AS value FROM versions GROUP BY 1, 2, 3)"""], f"""
SELECT 'u' || station_id AS station_id, field, {END} AS hour, count(*) AS n, {r('avg(value)', 'mean')} FROM last GROUP BY 1, 2, 3""")
    sql["q_asof_align"] = q([POINTS, "l AS (SELECT station_id, event_id, ts, value AS t_db FROM pts WHERE field = 't_db')",
                             "h AS (SELECT station_id, ts, max(value) AS rh FROM pts WHERE field = 'rh' GROUP BY 1, 2)"], f"""
SELECT l.station_id, event_id, l.ts, {r('t_db')}, CASE WHEN l.ts <= h.ts + INTERVAL 6 HOUR THEN h.ts END AS ts_right, {r('CASE WHEN l.ts <= h.ts + INTERVAL 6 HOUR THEN rh END', 'rh')}
FROM l ASOF LEFT JOIN h ON l.station_id = h.station_id AND l.ts >= h.ts""")
    sql["q_files_against_stations"] = q([SUP, "files AS (SELECT o_orderpriority AS file, CAST(o_orderdate AS DATE) AS day, avg(o_totalprice)/19000 AS y FROM orders GROUP BY 1, 2)",
                                         """pairs AS (SELECT file, s_suppkey AS station_id FROM supplier, (SELECT DISTINCT file, CAST(left(file, 1) AS INTEGER) - 1 AS n FROM files)
  WHERE s_suppkey % 5 IN (n % 5, (n + 2) % 5))""",
                                         "both_ AS (SELECT p.file, s.station_id, t_db AS x, y FROM sup s JOIN pairs p USING (station_id) LEFT JOIN files f ON f.file = p.file AND f.day = s.day)",
                                         "centred AS (SELECT *, x - avg(x) OVER w AS dx, y - avg(y) OVER w AS dy FROM both_ WINDOW w AS (PARTITION BY file, station_id))"], f"""
SELECT file, station_id, {r('avg(x - y)', 'bias')}, {r('sum(dx*dy)/nullif(sqrt(sum(dx*dx))*sqrt(sum(dy*dy)), 0)', 'r')} FROM centred GROUP BY 1, 2""")
    sql["q_tmy_iso_gridded"] = q([FLAG, "grid AS (SELECT station_id, day, t_db, ghi/3 + (rh - 40)/pi() AS ghi, rh, v_air FROM flag)", fs("grid", "stat", True), chosen("stat", "best")], f"""
SELECT f.station_id, {in_1970('f.day')} AS tmy_ts, {r('t_db')}, {r('ghi', 'dif')}, {r('rh')}, {r('v_air')}
FROM grid f JOIN best b ON f.station_id = b.station_id AND year(f.day) = b.y AND month(f.day) = b.m WHERE {not_leap('f.day')}""")

    sql["q_pearson_bias"] = q(
        [SUP, """ext AS (SELECT CAST(o_orderdate AS DATE) AS day, avg(o_totalprice) AS p FROM orders GROUP BY 1)""",
         """pairs AS (SELECT station_id, CASE WHEN rh < 90 THEN t_db END AS x,
  CASE WHEN p < 270000 THEN p/19000 END AS y FROM sup s LEFT JOIN ext e ON s.day = e.day)""",
         "centred AS (SELECT *, x - avg(x) OVER (PARTITION BY station_id) AS dx, y - avg(y) OVER (PARTITION BY station_id) AS dy FROM pairs)"], f"""
SELECT station_id, {r('avg(x - y)', 'bias')}, {r('sum(dx*dy)/(sqrt(sum(dx*dx))*sqrt(sum(dy*dy)))', 'r')} FROM centred GROUP BY 1""")
    sql["q_compare_sources"] = "SELECT l_suppkey AS station_id, CAST(year(l_shipdate) AS BIGINT) AS year, " + ", ".join(
        r(f"avg(l_quantity*pi()) FILTER (l_returnflag = '{f}')", f'"{f}"') for f in "ANR") + " FROM lineitem GROUP BY l_suppkey, year(l_shipdate)"
    sql["q_compare_methods"] = q([*ISO, *mean_days[1:2]], f"""
SELECT station_id, tmy_ts, {r("avg(t_db) FILTER (method = 'iso')", 'iso')}, {r("avg(t_db) FILTER (method = 'mean')", 'mean')} FROM (
  SELECT station_id, tmy_ts, t_db, 'iso' AS method FROM iso_rows
  UNION ALL SELECT station_id, tmy_ts, avg(t_db), 'mean' FROM days GROUP BY 1, 2) GROUP BY 1, 2""")
    return sql
