"""Registered queries: one per operator group of SURVEY section 2.

Each query reads the provided tables through the fixture view and runs the
library operators; :data:`ORACLE` holds the equivalent DuckDB SQL over the
same tables. Column names match between both.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions import columns
from ..functions.scalar import day_fraction, r6
from ..operators import areas, battery, distance, geo, history, periods, profile, ranking, rollup, sketches, stats, trips
from ..session import own_path, reliable_checkpoint, stored
from ..sources import raw
from ..sources import fixture
from . import export, jobs, publish
from . import sqlfrag as S

# Trip break used on the fixture: its median gap between records is ~21 h, so
# the reference's 600 s default would leave almost no trips.
FIXTURE_TRIP_GAP_S = 24 * 3600

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def tele(spark, sf_dir):
    return fixture.telemetry(spark, sf_dir)



# ---------------------------------------------------------------- B2 / B3
@register("daily_distance", f"""{S.WITH_TELE},
s AS (SELECT vin, day, odo,
             odo - lag(odo) OVER (PARTITION BY vin, day ORDER BY ts, event_id) AS step
      FROM tele WHERE {S.DRIVING}),
a AS (SELECT vin, day, count(*) AS n_records,
             CAST(COALESCE(sum(CASE WHEN abs(step) < 10 THEN step END), 0) AS DOUBLE) AS signed,
             CAST(COALESCE(sum(CASE WHEN abs(step) >= 10 THEN step END), 0) AS DOUBLE) AS big
      FROM s GROUP BY vin, day)
SELECT vin, day, {S.r6('abs(signed)')} AS distance, {S.r6('big * sign(signed)')} AS "offset", n_records
FROM a""")
def q_daily_distance(spark, sf_dir):
    """Flagship: driving rows (P12) -> per vehicle-day odometer distance and
    offset (W4, B2, B3) with one shuffle on (vin, day)."""
    return distance.odometer_distance(tele(spark, sf_dir).where(P.driving()), ("vin", "day"))


# ---------------------------------------------------------------- B4
@register("battery_distance", f"""{S.WITH_TELE},
r AS (SELECT vin, day, ts, event_id, odo, {S.on_battery()} AS flag,
             lag({S.on_battery()}) OVER w AS pflag,
             last(CASE WHEN {S.on_battery()} THEN odo END IGNORE NULLS) OVER
               (PARTITION BY vin, day ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pbodo
      FROM tele WINDOW w AS (PARTITION BY vin, day ORDER BY ts, event_id)),
s AS (SELECT *, CASE WHEN flag AND NOT COALESCE(pflag, false) THEN 1 ELSE 0 END AS start FROM r),
g AS (SELECT *, SUM(start) OVER (PARTITION BY vin, day ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) - start AS seg,
             CASE WHEN flag THEN odo - pbodo END AS step FROM s),
p AS (SELECT vin, day, seg, abs(COALESCE(sum(CASE WHEN abs(step) < 10 THEN step END), 0)) AS segd
      FROM g GROUP BY vin, day, seg)
SELECT vin, day, {S.r6('CAST(sum(segd) AS DOUBLE)')} AS distance_on_battery FROM p GROUP BY vin, day""")
def q_battery_distance(spark, sf_dir):
    """Distance driven on battery per vehicle-day (runs of consecutive
    battery-driving rows, gap difference owned by the run on the left)."""
    return distance.battery_distance(tele(spark, sf_dir), ("vin", "day"))


# ---------------------------------------------------------------- B1 / W3
_TRIP_ROWS = f"""
d AS (SELECT * FROM tele WHERE {S.DRIVING} AND lat IS NOT NULL AND lon IS NOT NULL),
g AS (SELECT *, lag(ts) OVER w AS pts, lag(odo) OVER w AS podo FROM d
      WINDOW w AS (PARTITION BY vin ORDER BY ts, event_id)),
b AS (SELECT *, CASE WHEN pts IS NOT NULL AND {S.gap('pts', 'ts')} > {FIXTURE_TRIP_GAP_S} THEN 1 ELSE 0 END AS brk FROM g),
t AS (SELECT *, CAST(SUM(brk) OVER (PARTITION BY vin ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS trip_no,
             CASE WHEN brk = 0 AND podo IS NOT NULL THEN odo - podo END AS step FROM b)"""


@register("trips", f"""{S.WITH_TELE}, {_TRIP_ROWS},
a AS (SELECT vin, trip_no, count(*) AS n_records,
             arg_min(ts, (ts, event_id)) AS start_time, arg_max(ts, (ts, event_id)) AS end_time,
             arg_min(lat, (ts, event_id)) AS start_lat, arg_min(lon, (ts, event_id)) AS start_lon,
             arg_max(lat, (ts, event_id)) AS end_lat, arg_max(lon, (ts, event_id)) AS end_lon,
             CAST(COALESCE(sum(CASE WHEN abs(step) < 10 THEN step END), 0) AS DOUBLE) AS signed
      FROM t GROUP BY vin, trip_no HAVING count(*) > 1)
SELECT vin, trip_no, n_records, start_time, end_time, start_lat, start_lon, end_lat, end_lon,
       {S.r6('abs(signed)')} AS distance,
       {S.gap('start_time', 'end_time')} AS dura_sec,
       {S.r6(S.gap('start_time', 'end_time') + ' / 3600.0')} AS duration,
       {S.duration_text(S.gap('start_time', 'end_time'))} AS duration_text,
       CAST(start_time AS DATE) AS day
FROM a""")
def q_trips(spark, sf_dir):
    """W1 + W3 + B1: trips of driving rows split at gaps over 8 h."""
    return trips.trips(tele(spark, sf_dir), max_gap_s=FIXTURE_TRIP_GAP_S)


@register("trip_points", f"""{S.WITH_TELE}, {_TRIP_ROWS}
SELECT vin, event_id, ts, lat, lon, trip_no FROM t""")
def q_trip_points(spark, sf_dir):
    """Labelled points of the trip sample: every driving row with its trip number."""
    lab = trips.label_trips(tele(spark, sf_dir), max_gap_s=FIXTURE_TRIP_GAP_S)
    return lab.select("vin", "event_id", "ts", "lat", "lon", "trip_no")


@register("record_gaps", f"""{S.WITH_TELE},
g AS (SELECT vin, event_id, ts,
             COALESCE({S.gap('lag(ts) OVER (PARTITION BY vin ORDER BY ts, event_id)', 'ts')}, 10) AS gap_s
      FROM tele)
SELECT vin, event_id, ts, gap_s FROM g WHERE gap_s > 5""")
def q_record_gaps(spark, sf_dir):
    """W1 + W2: seconds since the vehicle's previous record (first = 10), rows
    closer than 5 s to their predecessor dropped."""
    g = trips.with_gap(tele(spark, sf_dir).select("vin", "event_id", "ts", "day"))
    return g.where(F.col("gap_s") > trips.NEAR_DUP_GAP_S).drop("day")


# ---------------------------------------------------------------- B8 / A1 / R10
@register("daily_stats", S.stat_row_sql("strftime(ts, '%Y-%m-%d')"))
def q_daily_stats(spark, sf_dir):
    """The full daily stat row per vehicle-day in one grouped pass."""
    return stats.daily_stats(tele(spark, sf_dir))


@register("hourly_stats", S.stat_row_sql("strftime(date_trunc('hour', ts), '%Y-%m-%d %H:00:00')", hourly=True))
def q_hourly_stats(spark, sf_dir):
    """Hourly subset (distance, average speed, charging/driving hours, charged energy)."""
    return stats.hourly_stats(tele(spark, sf_dir))


@register("state_counts", f"""{S.WITH_TELE}
SELECT vin, count(*) AS n_all, CAST(count_if({S.charging('CAST(0.000001 AS DOUBLE)')}) AS BIGINT) AS n_charging,
       CAST(count_if({S.DRIVING}) AS BIGINT) AS n_driving FROM tele GROUP BY vin""")
def q_state_counts(spark, sf_dir):
    """Record counts by state per vehicle."""
    return stats.state_counts(tele(spark, sf_dir))


# ---------------------------------------------------------------- B9-B13 periods
FIXTURE_PERIOD_GAP_S = 24 * 3600


def _full_soc_sql(charging: bool, delta_min=50, delta_max=100) -> str:
    lo, hi = ("start_soc", "end_soc") if charging else ("end_soc", "start_soc")
    return (f"abs(delta_soc) >= {delta_min} AND abs(delta_soc) <= {delta_max} "
            f"AND {lo} BETWEEN 0 AND 100 AND {hi} BETWEEN 0 AND 100")


@register("charging_periods", S.period_stats_sql(S.charging("0"), FIXTURE_PERIOD_GAP_S, 120, 1))
def q_charging_periods(spark, sf_dir):
    """B9-B13 (kind 1): charging periods with Ah/kWh sums, trapezoid
    integration over corrected time, time and SOC compensation."""
    return periods.periods(tele(spark, sf_dir), "charging", max_gap_s=FIXTURE_PERIOD_GAP_S)


@register("driving_periods", S.period_stats_sql(S.on_battery(), FIXTURE_PERIOD_GAP_S, 120, 3))
def q_driving_periods(spark, sf_dir):
    """B9 (kind 3): driving-on-battery periods (trips on battery)."""
    return periods.periods(tele(spark, sf_dir), "driving", max_gap_s=FIXTURE_PERIOD_GAP_S)


@register("charging_full_soc", S.period_stats_sql(S.charging("0"), FIXTURE_PERIOD_GAP_S, 120, 2,
                                                 _full_soc_sql(True)))
def q_charging_full_soc(spark, sf_dir):
    """Kind 2: charging periods inside the full-SOC windows."""
    return periods.periods(tele(spark, sf_dir), "charging_full_soc", max_gap_s=FIXTURE_PERIOD_GAP_S)


@register("driving_full_soc", S.period_stats_sql(S.on_battery(), FIXTURE_PERIOD_GAP_S, 120, 4,
                                                _full_soc_sql(False)))
def q_driving_full_soc(spark, sf_dir):
    """Kind 4: driving-on-battery periods inside the full-SOC windows."""
    return periods.periods(tele(spark, sf_dir), "driving_full_soc", max_gap_s=FIXTURE_PERIOD_GAP_S)


@register("soc_category_capacity", f"""WITH per AS ({S.period_stats_sql(S.charging("0"), FIXTURE_PERIOD_GAP_S, 120, 1)})
SELECT CAST(ceil(delta_soc / 10) * 10 AS DOUBLE) AS category, count(*) AS n_periods,
       {S.r6(S.avg6('normalized_ah_throughput'))} AS normalized_ah_throughput_avg
FROM per WHERE delta_soc > 40 AND end_soc > 90 GROUP BY 1""")
def q_soc_category_capacity(spark, sf_dir):
    """B20 + P17 + F7: capacity by delta-SOC category of charging periods."""
    per = periods.periods(tele(spark, sf_dir), "charging", max_gap_s=FIXTURE_PERIOD_GAP_S)
    return periods.soc_category_capacity(per)


# ---------------------------------------------------------------- rankings
FIXTURE_VINTYPE = "AUTOMOBILE"
_VEH_SQL = f"(SELECT c_custkey FROM customer WHERE c_mktsegment = '{FIXTURE_VINTYPE}')"


def _per(spark, sf_dir, kind):
    return periods.periods(tele(spark, sf_dir), kind, max_gap_s=FIXTURE_PERIOD_GAP_S)


def _per_sql(kind: str) -> str:
    flag = S.charging("0") if kind.startswith("charging") else S.on_battery()
    k = periods.KIND[kind]
    where = _full_soc_sql(kind.startswith("charging")) if kind.endswith("full_soc") else None
    return S.period_stats_sql(flag, FIXTURE_PERIOD_GAP_S, 120, k, where)


def _both(spark, sf_dir):
    """Charging and driving periods in one pass."""
    return periods.periods_of(tele(spark, sf_dir), max_gap_s=FIXTURE_PERIOD_GAP_S)


def _by_vehicle_sql(src: str, spec: dict, extra_where: str = "") -> str:
    aggs = []
    for col, names in spec.items():
        for a in names:
            e = {"wmean": f"CASE WHEN count({col}) = count(*) THEN sum(_w * {col}) / sum(_w) END",
                 "count": f"count({col})", "min": f"min({col})", "max": f"max({col})",
                 "mean": S.avg6(col)}[a]
            aggs.append(f"{S.r6(e) if a != 'count' else e} AS {col}_{a}")
    return f"""(SELECT vin, {', '.join(aggs)} FROM
      (SELECT *, row_number() OVER (PARTITION BY vin ORDER BY end_time, period_no)
                 / count(*) OVER (PARTITION BY vin) / 2 + 0.5 AS _w
       FROM {src} WHERE vin IN {_VEH_SQL} AND day > CAST(_end - INTERVAL 30 DAY AS DATE) {extra_where}) x
      GROUP BY vin)"""


_BASE_SPEC = {"cell_volt_diff_mean": ("wmean", "count"), "battery_temp_min": ("min",),
              "battery_temp_max": ("max",), "battery_temp_avg": ("mean",)}


def _ranking_sql(min_records=1, min_periods=1) -> str:
    cw = f"AND count_records > {min_records}"
    chg = _by_vehicle_sql("(SELECT * FROM cp, e)", _BASE_SPEC, cw)
    drv = _by_vehicle_sql("(SELECT * FROM dp, e)", _BASE_SPEC, cw)
    cf = _by_vehicle_sql("(SELECT * FROM cf, e)", {"normalized_ah_throughput": ("wmean", "count")})
    df_ = _by_vehicle_sql("(SELECT * FROM df, e)", {"normalized_ah_consumption": ("wmean", "count"),
                                                   "normalized_distance_driven": ("wmean",)})
    return f"""WITH cp AS ({_per_sql('charging')}), dp AS ({_per_sql('driving')}),
cf AS ({_per_sql('charging_full_soc')}), df AS ({_per_sql('driving_full_soc')}),
e AS (SELECT max(day) AS _end FROM dp),
c1 AS (SELECT * FROM {chg} WHERE cell_volt_diff_mean_count > {min_periods}),
d1 AS (SELECT * FROM {drv} WHERE cell_volt_diff_mean_count > {min_periods}),
c2 AS (SELECT * FROM {cf} WHERE normalized_ah_throughput_count > {min_periods}),
d2 AS (SELECT * FROM {df_} WHERE normalized_ah_consumption_count > {min_periods}),
m AS (SELECT COALESCE(c1.vin, d1.vin) AS vin,
        d1.battery_temp_min_min AS battery_temp_min_driving, d1.battery_temp_max_max AS battery_temp_max_driving,
        d1.battery_temp_avg_mean AS battery_temp_mean_driving, d1.cell_volt_diff_mean_wmean AS cell_volt_diff_mean_driving,
        c1.battery_temp_min_min AS battery_temp_min_charging, c1.battery_temp_max_max AS battery_temp_max_charging,
        c1.battery_temp_avg_mean AS battery_temp_mean_charging, c1.cell_volt_diff_mean_wmean AS cell_volt_diff_mean_charging
      FROM c1 FULL OUTER JOIN d1 ON c1.vin = d1.vin)
SELECT m.*, c2.normalized_ah_throughput_wmean AS normalized_ah_charged_mean,
       d2.normalized_ah_consumption_wmean AS normalized_ah_consumption_mean,
       d2.normalized_distance_driven_wmean AS normalized_distance_driven_mean
FROM m LEFT JOIN c2 ON m.vin = c2.vin LEFT JOIN d2 ON m.vin = d2.vin"""


@register("vehicle_ranking", _ranking_sql())
def q_vehicle_ranking(spark, sf_dir):
    """A11 recency-weighted means per vehicle of four period tables,
    A13 minimum counts, full outer + two left joins (J4, J5), renames (P1)."""
    return ranking.vehicle_ranking(_both(spark, sf_dir), fixture.vehicles(spark, sf_dir), FIXTURE_VINTYPE,
                                   day_range=30, min_count_records=1, min_count_periods=1)


@register("cell_volt_ranking", f"""WITH ds AS ({S.stat_row_sql("strftime(ts, '%Y-%m-%d')")}),
recent AS (SELECT vin, cell_volt_diff_avg, newest FROM (SELECT *, max(day) OVER () AS newest FROM ds)
           WHERE vin IN {_VEH_SQL} AND newest - day < 30),
spread AS (SELECT vin, newest, {S.r6(S.avg6('cell_volt_diff_avg'))} AS mean_daily_avg_cell_volt_diff
           FROM recent GROUP BY vin, newest HAVING count(*) >= 6)
SELECT vin, CAST(rank() OVER (ORDER BY mean_daily_avg_cell_volt_diff DESC, vin) AS BIGINT) AS row_number,
       mean_daily_avg_cell_volt_diff, current_date AS update_date, newest AS last_daily_stats_day FROM spread""")
def q_cell_volt_ranking(spark, sf_dir):
    """Last-30-day mean of the daily cell-voltage spread per vehicle of
    one type, at least 6 days, globally ranked (W6) without a single-partition window."""
    daily = stats.daily_stats(tele(spark, sf_dir))
    return ranking.cell_volt_ranking(daily, fixture.vehicles(spark, sf_dir), FIXTURE_VINTYPE)


def _month_compare_sql(min_counts=0) -> str:
    cols = {"ah": "normalized_ah_throughput", "missing_time": "_mt", "min_temp": "battery_temp_min",
            "max_temp": "battery_temp_max", "avg_temp": "battery_temp_avg"}
    aggs, outs = [], []
    for tag, m in (("a", 1), ("b", 2)):
        for k, c in cols.items():
            e = f"CASE WHEN _month = {m} THEN {c} END"
            aggs.append(f"{S.avg6(e) if c != '_mt' else f'avg({e})'} AS avg_{k}_{tag}")
        aggs.append(f"count(CASE WHEN _month = {m} THEN _mt END) AS counts_{tag}")
    for k in cols:
        for tag in ("a", "b"):
            outs.append(f"{S.r6(f'avg_{k}_{tag}')} AS avg_{k}_{tag}")
    return f"""WITH p AS ({_per_sql('charging')}),
q AS (SELECT *, month(day) AS _month,
        CASE WHEN duration <> 0 THEN (duration - count_records / 360) / duration * 100 END AS _mt
      FROM p WHERE vin IN {_VEH_SQL}),
g AS (SELECT vin, {', '.join(aggs)} FROM q GROUP BY vin)
SELECT vin, {S.r6('CASE WHEN avg_ah_b <> 0 THEN (avg_ah_b - avg_ah_a) / avg_ah_b * 100 END')} AS ah_percent_diff,
       {', '.join(outs)}
FROM g WHERE counts_a > {min_counts} AND counts_b > {min_counts}"""


@register("month_compare", _month_compare_sql())
def q_month_compare(spark, sf_dir):
    """A20 + J2: change of normalised Ah per vehicle from January to February."""
    return ranking.month_compare(_per(spark, sf_dir, "charging"), fixture.vehicles(spark, sf_dir),
                                 FIXTURE_VINTYPE, min_counts=0)


@register("top_vehicles", f"""WITH p AS ({_per_sql('driving')}),
c AS (SELECT vin, count(day) AS counts FROM p GROUP BY vin)
SELECT c.vin, c_mktsegment AS vintype, counts FROM c JOIN customer ON c.vin = c_custkey
WHERE c_mktsegment = '{FIXTURE_VINTYPE}' ORDER BY counts DESC, c.vin LIMIT 20""")
def q_top_vehicles(spark, sf_dir):
    """T2 + J1: top-20 vehicles of a type by number of driving periods."""
    return ranking.top_vehicles(_per(spark, sf_dir, "driving"), fixture.vehicles(spark, sf_dir),
                                FIXTURE_VINTYPE, 20)


def _series_part(kind: str, label: str) -> str:
    return (f"SELECT vin, '{label}' AS series, start_time, end_time, day, delta_soc, duration, count_records, "
            f"{S.r6('duration - count_records * 10 / 3600')} AS missing_time_h, missing_time_pct "
            f"FROM ({_per_sql(kind)}) x")


@register("vehicle_series", f"""{_series_part('charging_full_soc', 'charging')}
UNION ALL {_series_part('driving_full_soc', 'driving')}""")
def q_vehicle_series(spark, sf_dir):
    """B23 + F16: charging and driving full-SOC periods with missing time."""
    return ranking.vehicle_series(_both(spark, sf_dir))


# ---------------------------------------------------------------- rollups
_DENSE_SQL = f"""ds AS ({S.stat_row_sql("strftime(ts, '%Y-%m-%d')")}),
fb AS (SELECT vin, min(day) AS f FROM ds GROUP BY vin), lb AS (SELECT max(day) AS l FROM ds),
cal AS (SELECT vin, CAST(unnest(generate_series(CAST(f AS TIMESTAMP), CAST(l AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day
        FROM fb, lb),
dd AS (SELECT cal.vin, cal.day, ds.distance_driven, ds.charging_hours, ds.speed_average, ds.speed_n,
              ds.vin IS NOT NULL AS present
       FROM cal LEFT JOIN ds ON cal.vin = ds.vin AND cal.day = ds.day)"""

_FOLD = """list_reduce(list_concat(
    [list({'avg': speed_average, 'n': CAST(COALESCE(speed_n, 0) AS BIGINT)} ORDER BY day)[1]],
    list({'avg': speed_average, 'n': CAST(COALESCE(speed_n, 0) AS BIGINT)} ORDER BY day)
      .list_filter(lambda e, i: i > 1 AND list(present ORDER BY day)[i])),
  lambda a, x: CASE WHEN a.avg IS NULL AND x.avg IS NULL THEN {'avg': CAST(NULL AS DOUBLE), 'n': CAST(0 AS BIGINT)}
    ELSE {'avg': CASE WHEN (CASE WHEN a.avg = 0 THEN 1 ELSE a.n END) + (CASE WHEN x.avg = 0 THEN 1 ELSE x.n END) <> 0
                 THEN (COALESCE(a.avg * (CASE WHEN a.avg = 0 THEN 1 ELSE a.n END), 0.0)
                       + COALESCE(x.avg * (CASE WHEN x.avg = 0 THEN 1 ELSE x.n END), 0.0))
                      / ((CASE WHEN a.avg = 0 THEN 1 ELSE a.n END) + (CASE WHEN x.avg = 0 THEN 1 ELSE x.n END)) END,
          'n': CAST((CASE WHEN a.avg = 0 THEN 1 ELSE a.n END) + (CASE WHEN x.avg = 0 THEN 1 ELSE x.n END) AS BIGINT)} END)"""


@register("monthly_rollup", f"""WITH {_DENSE_SQL},
m AS (SELECT vin, strftime(day, '%Y') || '-' || CAST(month(day) AS VARCHAR) AS mon,
             {S.sum6('distance_driven')} AS md, {S.sum6('charging_hours')} AS ch, {_FOLD} AS sp
      FROM dd GROUP BY 1, 2)
SELECT vin, 'miles_driven' AS stat, 'monthly' AS freq, mon AS time_label, {S.r6('md')} AS value,
       CAST(NULL AS BIGINT) AS weight FROM m
UNION ALL SELECT vin, 'charging_hours', 'monthly', mon, {S.r6('ch')}, CAST(NULL AS BIGINT) FROM m
UNION ALL SELECT vin, 'average_speed', 'monthly', mon, {S.r6('sp.avg')}, sp.n FROM m""")
def q_monthly_rollup(spark, sf_dir):
    """R1-R4 + W10: daily stats on a dense per-vehicle calendar rolled up to
    months (null-aware sums, ordered weighted speed average)."""
    return rollup.monthly_rollup(stats.daily_stats(tele(spark, sf_dir)))


@register("daily_long", f"""WITH {_DENSE_SQL}
SELECT vin, 'miles_driven' AS stat, 'daily' AS freq, strftime(day, '%Y-%m-%d') AS time_label,
       distance_driven AS value, CAST(NULL AS BIGINT) AS weight FROM dd
UNION ALL SELECT vin, 'charging_hours', 'daily', strftime(day, '%Y-%m-%d'), charging_hours, CAST(NULL AS BIGINT) FROM dd
UNION ALL SELECT vin, 'average_speed', 'daily', strftime(day, '%Y-%m-%d'), speed_average,
                 CAST(COALESCE(speed_n, 0) AS BIGINT) FROM dd""")
def q_daily_long(spark, sf_dir):
    """R3 + W10: daily long-form stats with a null entry for every day a
    vehicle is missing after its first day."""
    return rollup.daily_long(stats.daily_stats(tele(spark, sf_dir)))


# ---------------------------------------------------------------- history corrected by late rows
_BATCH_SQL = (f"SELECT * REPLACE (CAST(vin AS VARCHAR) || '|' || CAST(CAST(ts + INTERVAL {fixture.FILE_LAG.split()[0]} HOUR AS DATE) AS VARCHAR) AS vin) FROM tele")


def _batch_rows_sql(label: str, hourly: bool = False) -> str:
    """Stat rows of every file day, combined per vehicle and label."""
    return f"""(SELECT vin, time_label, max(batch) AS batch,
  CASE WHEN count(*) = 1 THEN max(distance_driven) ELSE {S.sum6('distance_driven')} END AS distance_driven,
  CASE WHEN count(*) = 1 THEN max(charging_hours) ELSE {S.sum6('charging_hours')} END AS charging_hours,
  CASE WHEN count(*) = 1 THEN max(speed_average)
       ELSE sum(speed_average * speed_n) / nullif(sum(CASE WHEN speed_average IS NOT NULL THEN speed_n END), 0) END AS speed_average,
  CAST(sum(speed_n) AS BIGINT) AS speed_n
FROM (SELECT * REPLACE (CAST(split_part(vin, '|', 1) AS BIGINT) AS vin), CAST(split_part(vin, '|', 2) AS DATE) AS batch
      FROM ({S.stat_row_sql(label, hourly=hourly, source_cte=_BATCH_SQL)}) x) y GROUP BY vin, time_label)"""


_HISTORY_SQL = f"""ds AS (SELECT *, CAST(time_label AS DATE) AS day FROM {_batch_rows_sql("strftime(ts, '%Y-%m-%d')")} z),
fb AS (SELECT vin, min(day) AS f FROM ds GROUP BY vin), lb AS (SELECT max(batch) AS l FROM ds),
cal AS (SELECT vin, CAST(unnest(generate_series(CAST(f AS TIMESTAMP), CAST(l AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day
        FROM fb, lb),
dd AS (SELECT cal.vin, cal.day, ds.distance_driven, ds.charging_hours, ds.speed_average, ds.speed_n,
              ds.vin IS NOT NULL AS present
       FROM cal LEFT JOIN ds ON cal.vin = ds.vin AND cal.day = ds.day)"""


def _history(spark, sf_dir, read: Callable) -> DataFrame:
    """``read`` of a history into which the day files came out of order (each third day, twice
    others), one part of them without some vehicles at first and then again in full."""
    t = tele(spark, sf_dir).withColumn("file_day", F.to_date(F.col("ts") + F.expr(f"INTERVAL {fixture.FILE_LAG}")))
    rows = stored(history.stat_rows(stats.period_stats(t, ("daily", "hourly"), keys=("file_day", "vin"))), "stat-rows")
    third = F.pmod(F.unix_date("batch"), F.lit(3))
    path = own_path(spark, "history")
    history.apply(spark, path, rows.where((third == 1) & (F.col("vin").cast("long") % 7 != 0)))
    history.apply(spark, path, rows.where(third == 2))
    history.compact(spark, path)
    history.apply(spark, path, rows.where(third == 0))
    history.apply(spark, path, rows.where(third == 1))
    return read(path).withColumn("vin", F.col("vin").cast("bigint"))


@register("corrected_history", f"""WITH {_HISTORY_SQL},
m AS (SELECT vin, strftime(day, '%Y') || '-' || CAST(month(day) AS VARCHAR) AS mon,
             {S.sum6('distance_driven')} AS md, {S.sum6('charging_hours')} AS ch, {_FOLD} AS sp
      FROM dd GROUP BY 1, 2)
SELECT vin, 'miles_driven' AS stat, 'monthly' AS freq, mon AS time_label, {S.r6('md')} AS value,
       CAST(NULL AS BIGINT) AS weight FROM m
UNION ALL SELECT vin, 'charging_hours', 'monthly', mon, {S.r6('ch')}, CAST(NULL AS BIGINT) FROM m
UNION ALL SELECT vin, 'average_speed', 'monthly', mon, {S.r6('sp.avg')}, sp.n FROM m
UNION ALL SELECT vin, 'miles_driven', 'daily', strftime(day, '%Y-%m-%d'), {S.r6('distance_driven')}, CAST(NULL AS BIGINT) FROM dd
UNION ALL SELECT vin, 'charging_hours', 'daily', strftime(day, '%Y-%m-%d'), {S.r6('charging_hours')}, CAST(NULL AS BIGINT) FROM dd
UNION ALL SELECT vin, 'average_speed', 'daily', strftime(day, '%Y-%m-%d'), {S.r6('speed_average')},
                 CAST(COALESCE(speed_n, 0) AS BIGINT) FROM dd""")
def q_corrected_history(spark, sf_dir):
    """J10 + R1-R4 + W10: daily and monthly rows of a history that got its day files out of order,
    with late records for earlier days and a file delivered again."""
    return _history(spark, sf_dir, lambda path: history.long_rows(spark, path, freqs=("daily", "monthly")))


@register("corrected_hours", f"""WITH {_HISTORY_SQL},
hs AS (SELECT * FROM {_batch_rows_sql("strftime(date_trunc('hour', ts), '%Y-%m-%d %H:00:00')", hourly=True)} z)
SELECT vin, time_label, {S.r6('distance_driven')} AS distance_driven, charging_hours, {S.r6('speed_average')} AS speed_average, speed_n FROM hs
UNION ALL SELECT vin, strftime(day, '%Y-%m-%d') || printf(' %02d:00:00', h), NULL, NULL, NULL, 0
FROM dd, (SELECT unnest(generate_series(0, 23)) AS h) WHERE NOT present""")
def q_corrected_hours(spark, sf_dir):
    """R3 hourly: the hours of the same history, 24 of nulls for a day that a known vehicle is missing."""
    def read(path):
        h = history.hourly(spark, path)
        return h.withColumn("distance_driven", r6("distance_driven")).withColumn("speed_average", r6("speed_average"))
    return _history(spark, sf_dir, read)


# ---------------------------------------------------------------- locations (B7, J6) and clusters
def _lookup(spark, sf_dir):
    """Coordinate lookup stand-in from nation/region (lat, lon text, seq, city, province)."""
    n = fixture.load(spark, sf_dir, "nation")
    r = fixture.load(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.format_string("%.2f", F.lit(23) + (F.col("n_nationkey") % 20) * F.lit(0.05).cast("double")).alias("lat"),
        F.lit("113.00").alias("lon"), F.col("n_nationkey").alias("seq"),
        F.col("n_name").alias("city"), F.col("r_name").alias("province"))


@register("primary_location", S.primary_location_sql(geo.LAST_N_RECORDS))
def q_primary_location(spark, sf_dir):
    """B7 + J6: most frequent 2-place coordinate of each vehicle's latest
    10,000 records, with city/province from the first lookup entry."""
    return geo.locate(geo.primary_locations(tele(spark, sf_dir)), _lookup(spark, sf_dir))


@register("primary_location_recent", S.primary_location_sql(25))
def q_primary_location_recent(spark, sf_dir):
    """B7 time-sorted variant with a short record window (N = 25 at fixture
    scale, so the W7 cutoff inside a day is exercised)."""
    return geo.locate(geo.primary_locations(tele(spark, sf_dir), n=25), _lookup(spark, sf_dir))


@register("charging_stations", f"""{S.clusters_sql()},
st AS (SELECT rep.center_lat AS station_lat, rep.center_lon AS station_lon, count(*) AS n_records,
       {S.r6('sum(charge_volt * charge_cur * 10 / 3600 / 1000)')} AS energy_kwh
       FROM u JOIN lab ON u.lat = lab.lat AND u.lon = lab.lon JOIN rep ON lab.clat = rep.clat AND lab.clon = rep.clon
       GROUP BY 1, 2)
SELECT st.*, u.vin AS rep_vin, u.ts AS rep_ts FROM st LEFT JOIN u ON u.lat = st.station_lat AND u.lon = st.station_lon""")
def q_charging_stations(spark, sf_dir):
    """Charging rows -> W2 -> A6 -> 20 m clusters (J9 + components) ->
    centermost point (A23/J8) -> energy per station (F14, J5, A7)."""
    return geo.charging_stations(tele(spark, sf_dir))


@register("station_clusters", f"""{S.clusters_sql()}
SELECT clat AS cluster_lat, clon AS cluster_lon, n_points, {S.r6('mlat')} AS centroid_lat,
       {S.r6('mlon')} AS centroid_lon, center_lat, center_lon, far_lat, far_lon, radius_m FROM rep""")
def q_station_clusters(spark, sf_dir):
    """Per cluster the count, centroid, centermost and farthest member."""
    t = tele(spark, sf_dir)
    ch = t.where(P.charging() & P.valid_coordinates() & F.col("charge_volt").isNotNull()
                 & F.col("charge_cur").isNotNull())
    ch = trips.drop_near_duplicates(ch, ("vin",)).select("lat", "lon").distinct()
    s = geo.cluster_summary(geo.cluster_points(ch))
    return s.select(F.col("cluster.lat").alias("cluster_lat"), F.col("cluster.lon").alias("cluster_lon"),
                    *[c for c in s.columns if c != "cluster"])


@register("energy_by_area", f"""{S.clusters_sql()},
st AS (SELECT rep.center_lat AS station_lat, rep.center_lon AS station_lon,
              {S.r6('sum(charge_volt * charge_cur * 10 / 3600 / 1000)')} AS energy_kwh
       FROM u JOIN lab ON u.lat = lab.lat AND u.lon = lab.lon JOIN rep ON lab.clat = rep.clat AND lab.clon = rep.clon
       GROUP BY 1, 2),
lk AS ({S.LOOKUP_FIRST_SQL})
SELECT province, city, {S.r6('sum(energy_kwh)')} AS energy_kwh, count(*) AS n_stations
FROM st LEFT JOIN lk ON {S.trunc_text('station_lat', 2)} = lk.lat AND {S.trunc_text('station_lon', 2)} = lk.lon
GROUP BY province, city""")
def q_energy_by_area(spark, sf_dir):
    """Charging-station energy by province and city via the lookup."""
    return geo.energy_by_area(geo.charging_stations(tele(spark, sf_dir)), _lookup(spark, sf_dir))


# districts: two polygons a nation, west and east of a slanted border, around the stand-in's positions
_AREAS_SQL = """SELECT n_nationkey * 2 + side AS area, r_name AS province, n_name AS city,
       n_name || CASE side WHEN 0 THEN ' west' ELSE ' east' END AS district,
       CAST(23 AS DOUBLE) + (n_nationkey % 20) * CAST(0.05 AS DOUBLE) AS c, side
FROM nation JOIN region ON n_regionkey = r_regionkey, (SELECT unnest([0, 1]) AS side)"""
_CORNERS = (((-0.02, 112.99), (0.02, 112.99), (0.02, 113.0003), (-0.02, 113.0001)), ((-0.02, 113.0001), (0.02, 113.0003), (0.02, 113.01), (-0.02, 113.01)))


def _areas(spark, sf_dir):
    """Area stand-in from nation/region: id, levels and ring."""
    n, r = fixture.load(spark, sf_dir, "nation"), fixture.load(spark, sf_dir, "region")
    c = F.lit(23).cast("double") + (F.col("n_nationkey") % 20) * F.lit(0.05).cast("double")
    ring = lambda k: F.array(*[F.struct((c + F.lit(dy)).alias("lat"), F.lit(x).alias("lon")) for dy, x in _CORNERS[k]])
    sides = F.array(*[F.struct(F.lit(k).alias("side"), ring(k).alias("ring")) for k in (0, 1)])
    both = n.join(r, n.n_regionkey == r.r_regionkey).withColumn("s", F.explode(sides))
    return both.select((F.col("n_nationkey") * 2 + F.col("s.side")).alias("area"), F.col("r_name").alias("province"), F.col("n_name").alias("city"),
                       F.concat("n_name", F.when(F.col("s.side") == 0, F.lit(" west")).otherwise(F.lit(" east"))).alias("district"), F.col("s.ring").alias("ring"))


def _edge_sql() -> str:
    rows = []
    for k, ring in enumerate(_CORNERS):
        for (ay, ax), (by, bx) in zip(ring, (*ring[1:], ring[0])):
            (ly, lx), (hy, hx) = ((ay, ax), (by, bx)) if ay <= by else ((by, bx), (ay, ax))
            rows.append(f"({k}, CAST({ly} AS DOUBLE), CAST({hy} AS DOUBLE), CAST({lx} AS DOUBLE), CAST({hx} AS DOUBLE))")
    return f"SELECT * FROM (VALUES {', '.join(rows)}) AS t(side, y0, y1, lon0, lon1)"


@register("energy_by_district", f"""{S.WITH_TELE},
ar AS ({_AREAS_SQL}), co AS ({_edge_sql()}),
ed AS (SELECT area, c + y0 AS lat0, c + y1 AS lat1, lon0, lon1 FROM ar JOIN co ON ar.side = co.side),
pt AS (SELECT lat, lon, sum(charge_volt * charge_cur * 10 / 3600 / 1000) AS kwh, count(*) AS n FROM tele
       WHERE COALESCE(charge_cur > 0, false) AND lat IS NOT NULL AND lon IS NOT NULL AND charge_volt IS NOT NULL GROUP BY lat, lon),
te AS (SELECT lat, lon, area,
              count_if(lat >= lat0 AND lat < lat1 AND (lon - lon0) * (lat1 - lat0) - (lon1 - lon0) * (lat - lat0) < 0) % 2 = 1
              OR bool_or((lon - lon0) * (lat1 - lat0) - (lon1 - lon0) * (lat - lat0) = 0 AND lat BETWEEN lat0 AND lat1
                         AND lon BETWEEN least(lon0, lon1) AND greatest(lon0, lon1)) AS inside
       FROM pt, ed GROUP BY lat, lon, area),
wi AS (SELECT lat, lon, min(area) AS area FROM te WHERE inside GROUP BY lat, lon)
SELECT province, city, district, {S.r6('sum(kwh)')} AS energy_kwh, CAST(sum(n) AS BIGINT) AS n_records
FROM pt LEFT JOIN wi ON pt.lat = wi.lat AND pt.lon = wi.lon LEFT JOIN ar ON wi.area = ar.area GROUP BY province, city, district""")
def q_energy_by_district(spark, sf_dir):
    """A8 by geometry: charging energy by province, city and district polygons."""
    return areas.energy_by_levels(tele(spark, sf_dir), _areas(spark, sf_dir))


# ---------------------------------------------------------------- B5 / W11 (SOC trips)
_SOC_TRIPS_SQL = f"""{S.WITH_TELE},
b AS (SELECT * FROM tele WHERE {S.DRIVING} AND COALESCE(fuel = 0, false) AND COALESCE(soc > 40, false)),
o AS (SELECT vin, ts, soc, day,
             row_number() OVER (PARTITION BY vin ORDER BY ts DESC, odo DESC NULLS LAST, event_id DESC) AS pos,
             max(day) OVER (PARTITION BY vin) AS e FROM b),
sm AS (SELECT * FROM (WITH RECURSIVE s(vin, pos, state, stopped, opos, last_soc, complete, sfrom, sto) AS (
    SELECT DISTINCT vin, CAST(0 AS BIGINT), 0, false, CAST(NULL AS BIGINT), CAST(NULL AS DOUBLE), false,
           CAST(NULL AS BIGINT), CAST(NULL AS BIGINT) FROM o
    UNION ALL
    SELECT s.vin, o.pos,
      CASE WHEN s.state = 0 THEN (CASE WHEN o.soc BETWEEN 60 AND 70 AND o.day = o.e THEN 1 ELSE 0 END)
           ELSE (CASE WHEN o.soc - s.last_soc > -1 THEN 1 ELSE 0 END) END,
      s.state = 0 AND o.soc BETWEEN 60 AND 70 AND o.day <> o.e,
      CASE WHEN s.state = 0 AND o.soc BETWEEN 60 AND 70 AND o.day = o.e THEN o.pos
           WHEN s.state = 1 AND o.soc - s.last_soc > -1 THEN s.opos END,
      CASE WHEN s.state = 0 AND o.soc BETWEEN 60 AND 70 AND o.day = o.e THEN o.soc
           WHEN s.state = 1 AND o.soc - s.last_soc > -1 THEN o.soc END,
      CASE WHEN s.state = 0 THEN false WHEN o.soc - s.last_soc > -1 THEN s.complete OR o.soc >= 90 ELSE false END,
      CASE WHEN s.state = 1 AND NOT (o.soc - s.last_soc > -1) AND s.complete THEN s.opos END,
      CASE WHEN s.state = 1 AND NOT (o.soc - s.last_soc > -1) AND s.complete THEN o.pos - 1 END
    FROM s JOIN o ON o.vin = s.vin AND o.pos = s.pos + 1 WHERE NOT s.stopped)
  SELECT * FROM s)),
fin AS (SELECT vin, max(pos) AS p FROM sm GROUP BY vin),
saves AS (SELECT vin, sfrom, sto FROM sm WHERE sfrom IS NOT NULL
          UNION ALL SELECT sm.vin, opos, pos FROM sm JOIN fin ON sm.vin = fin.vin AND sm.pos = fin.p
          WHERE state = 1 AND complete)
SELECT o.vin, arg_max(ts, pos) AS start_time, arg_min(ts, pos) AS end_time,
       {S.r6('arg_max(soc, pos)')} AS start_soc, {S.r6('arg_min(soc, pos)')} AS end_soc,
       {S.r6('max(CASE WHEN pos > sfrom THEN soc END)')} AS max_soc, count(*) AS n_records
FROM saves JOIN o ON o.vin = saves.vin AND o.pos BETWEEN sfrom AND sto
GROUP BY o.vin, sfrom"""


@register("soc_trips", _SOC_TRIPS_SQL)
def q_soc_trips(spark, sf_dir):
    """Trips on battery ending on each vehicle's last day, found from
    the SOC curve (scan newest to oldest: 60-70 % opener, rising SOC back in
    time up to >= 90 %) with window functions instead of a per-row loop."""
    return battery.soc_trips(battery.battery_rows(tele(spark, sf_dir)))


# ---------------------------------------------------------------- B19, B16-B18 / W14, W12-W13, P24
_POLAR_FLAG = f"({S.charging('0')} AND COALESCE(cell_volt_max >= 3.8 AND cell_volt_max <= 4.1, false))"


@register("polarization_periods", S.period_stats_sql(_POLAR_FLAG, FIXTURE_PERIOD_GAP_S, 60, 5, None, 1.0))
def q_polarization_periods(spark, sf_dir):
    """B19 (kind 5): charging rows with the max cell voltage in 3.8-4.1 V,
    split where it drops by more than 1 V, time compaction at 60 s."""
    return periods.periods(tele(spark, sf_dir), "polarization", max_gap_s=FIXTURE_PERIOD_GAP_S)


_CHG_ROWS = f"""{S.WITH_TELE}, {S.period_rows_sql(S.charging('0'), FIXTURE_PERIOD_GAP_S)}"""


def _current_models_sql(trim: bool) -> str:
    sel = ("sdx AS (SELECT * FROM sd QUALIFY CASE WHEN side = 0 THEN soc > min(soc) OVER (PARTITION BY vin, period_no, side) "
           "ELSE soc < max(soc) OVER (PARTITION BY vin, period_no, side) END)") if trim else "sdx AS (SELECT * FROM sd)"
    return f"""{_CHG_ROWS},
n0 AS (SELECT *, row_number() OVER w AS rn, curr - lag(curr) OVER w AS dcur, lag(ts) OVER w AS lts
       FROM r WINDOW w AS (PARTITION BY vin, period_no ORDER BY ts, event_id)),
n AS (SELECT *, CASE WHEN lts IS NULL THEN 0 WHEN {S.gap('lts', 'ts')} > 120 THEN 10
                     ELSE {S.gap('lts', 'ts')} END AS dtc0 FROM n0),
sp AS (SELECT *, COALESCE(min(CASE WHEN abs(dcur) > 5.0 THEN rn END) OVER (PARTITION BY vin, period_no), 2) AS split_rn,
              sum(dtc0) OVER (PARTITION BY vin, period_no ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS t_corr FROM n),
sd AS (SELECT *, CAST(rn >= split_rn AS INTEGER) AS side FROM sp),
{sel},
sides AS (SELECT vin, period_no, side, avg(curr) AS i_mean, max(t_corr) - min(t_corr) + 10 AS span_s
          FROM sdx GROUP BY ALL),
model AS (SELECT vin, period_no, sum(i_mean * span_s / 3600) AS ah_const FROM sides GROUP BY ALL),
line AS (SELECT vin, period_no, regr_slope(curr, t_corr) AS b, regr_intercept(curr, t_corr) AS a,
                min(t_corr) AS t0, max(t_corr) AS t1, arg_min(soc, (ts, event_id)) AS s0,
                arg_max(soc, (ts, event_id)) AS s1 FROM sdx GROUP BY ALL),
j AS (SELECT model.*, a, b, t0, t1, abs(s1 - s0) AS ads,
             (a * (t1 - t0) + b * (t1 * t1 - t0 * t0) / 2) / 3600 AS integral FROM model JOIN line USING (vin, period_no))
SELECT vin, period_no, {S.r6('ah_const')} AS ah_const_current,
       {S.r6('CASE WHEN ads <> 0 THEN ah_const / ads * 100 END')} AS normalized_ah_const_current,
       {S.r6('integral')} AS ah_linear_fit, {S.r6('CASE WHEN ads <> 0 THEN integral / ads * 100 END')} AS normalized_ah_linear_fit
FROM j"""


@register("current_models", _current_models_sql(False))
def q_current_models(spark, sf_dir):
    """B16 + B18 with the W14 split: constant-current halves and a straight
    line fitted to current over corrected time, per charging period."""
    return periods.constant_current_models(tele(spark, sf_dir), "charging", max_gap_s=FIXTURE_PERIOD_GAP_S)


@register("current_models_trimmed", _current_models_sql(True))
def q_current_models_trimmed(spark, sf_dir):
    """B17 + B16/B18: as current_models after trimming the lowest-SOC rows of
    the first side and the highest-SOC rows of the second."""
    return periods.constant_current_models(tele(spark, sf_dir), "charging", max_gap_s=FIXTURE_PERIOD_GAP_S, trim=True)


@register("charge_soc_ranges", f"""WITH p AS ({_per_sql('charging')})
SELECT vin, day, 'start' AS edge, CAST(ceil(start_soc / 10) * 10 AS DOUBLE) AS soc_bucket, count(*) AS n_periods
FROM p GROUP BY ALL
UNION ALL SELECT vin, day, 'end', CAST(ceil(end_soc / 10) * 10 AS DOUBLE), count(*) FROM p GROUP BY ALL""")
def q_charge_soc_ranges(spark, sf_dir):
    """B8 soc_range_charge_start/end (ours): charging periods counted by the
    10 % bucket (F7 upper edge) of their first and last SOC, per vehicle-day."""
    return periods.charge_soc_ranges(_per(spark, sf_dir, "charging"))


_GRID_STEP = 180


@register("soc_grid", f"""{_CHG_ROWS},
bnd AS (SELECT vin, period_no, min(ts) AS t0, max(ts) AS t1 FROM r GROUP BY ALL),
grid AS (SELECT vin, period_no, t0 + to_seconds(k * {_GRID_STEP}) AS ts FROM
         (SELECT *, unnest(generate_series(0, ({S.gap('t0', 't1')}) // {_GRID_STEP})) AS k FROM bnd)),
u AS (SELECT vin, period_no, ts, CAST(soc AS DOUBLE) AS v, false AS is_grid FROM r
      UNION ALL SELECT vin, period_no, ts, CAST(NULL AS DOUBLE), true FROM grid),
f AS (SELECT *, last(CASE WHEN NOT is_grid AND v IS NOT NULL THEN {{'t': ts, 'v': v}} END IGNORE NULLS)
                  OVER (PARTITION BY vin, period_no ORDER BY ts, is_grid ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS p,
                first(CASE WHEN NOT is_grid AND v IS NOT NULL THEN {{'t': ts, 'v': v}} END IGNORE NULLS)
                  OVER (PARTITION BY vin, period_no ORDER BY ts, is_grid ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nx
      FROM u),
gi AS (SELECT vin, period_no, ts,
             CASE WHEN nx IS NULL OR epoch_us(nx.t) = epoch_us(p.t) THEN p.v
                  ELSE p.v + (nx.v - p.v) * (epoch_us(ts) - epoch_us(p.t)) / (epoch_us(nx.t) - epoch_us(p.t)) END AS soc
      FROM f WHERE is_grid)
SELECT vin, period_no, ts, {S.r6('soc')} AS soc,
       {S.r6(f'(soc - lag(soc) OVER (PARTITION BY vin, period_no ORDER BY ts)) / ({_GRID_STEP} / 60.0)')} AS slope_per_min
FROM gi""")
def q_soc_grid(spark, sf_dir):
    """W12 + W13: SOC of each charging period interpolated on a 3-minute grid
    and its slope per minute."""
    lab = periods.label_periods(tele(spark, sf_dir), "charging", max_gap_s=FIXTURE_PERIOD_GAP_S, known="soc")
    return periods.grid_interpolate(lab, step_s=_GRID_STEP)


@register("low_capacity_periods", f"""SELECT vin, start_time, end_time, normalized_ah_throughput
FROM ({_per_sql('charging')}) p WHERE normalized_ah_throughput < 5.0""")
def q_low_capacity_periods(spark, sf_dir):
    """Charging periods whose normalised Ah throughput is below 5."""
    return periods.low_capacity_periods(_per(spark, sf_dir, "charging"), 5.0)


# ---------------------------------------------------------------- raw sources
_RAW_A_SQL = f"""{S.WITH_TELE},
ra AS (SELECT CAST(vin AS VARCHAR) AS vin, CASE WHEN event_id % 107 <> 0 THEN (epoch_us(ts) // 1000) - 28800000 END AS ts_ms,
              CASE WHEN event_id % 107 <> 0 THEN make_timestamp((epoch_us(ts) // 1000) * 1000) END AS ts2, CAST(ts AS DATE) AS sdate,
              CAST(ts + INTERVAL 2 HOUR AS DATE) AS file_day, curr, volt, cell_volt_max, cell_volt_min, soc,
              temp_avg, temp_max, temp_min, charge_volt, charge_cur, acc_pedal, brake_pedal, fuel,
              CAST(charge_st AS DOUBLE) AS charge_st, speed, CAST(odo AS DOUBLE) AS odo, lon, lat
       FROM (SELECT *, unnest(generate_series(1, CASE WHEN event_id % 103 = 0 THEN 2 ELSE 1 END)) AS copy FROM tele) WHERE event_id % 97 <> 0)"""


@register("raw_records_a", f"""{_RAW_A_SQL}
SELECT * EXCLUDE (ts2), ts2 AS ts, CAST(ts2 AS DATE) AS day FROM ra""")
def q_raw_records_a(spark, sf_dir):
    """S1-S3 + P5-P8: schema-A text lines (85/86 fields) guarded, projected
    by position, null tokens cleaned, numbers try-cast, epoch ms converted to
    the local clock, yyyymmdd date parsed."""
    return raw.parse_schema_a(fixture.raw_lines_a(spark, sf_dir)).drop("event_id")


@register("raw_rejects", f"""{S.WITH_TELE}
SELECT CAST(ts + INTERVAL 2 HOUR AS DATE) AS file_day, 84 AS n_fields,
       CAST(sum(CASE WHEN event_id % 103 = 0 THEN 2 ELSE 1 END) AS BIGINT) AS n_lines
FROM tele WHERE event_id % 97 = 0 GROUP BY 1""")
def q_raw_rejects(spark, sf_dir):
    """Lines with a field count other than 85/86, counted per file day."""
    _, rejected = raw.guard(fixture.raw_lines_a(spark, sf_dir))
    return rejected.withColumn("n_fields", F.col("n_fields").cast("int"))


@register("late_records", f"""{_RAW_A_SQL}
SELECT file_day, CAST(ts2 AS DATE) AS day, count(*) AS n_records, min(ts2) AS first_ts, max(ts2) AS last_ts,
       CAST(file_day - CAST(ts2 AS DATE) AS INTEGER) AS days_late
FROM ra WHERE CAST(ts2 AS DATE) <> file_day GROUP BY 1, 2""")
def q_late_records(spark, sf_dir):
    """A22 + P25: records in a day's file dated on another day."""
    return profile.late_records(raw.parse_schema_a(fixture.raw_lines_a(spark, sf_dir)))


_RAW_B_SQL = f"""{S.WITH_TELE},
rb AS (SELECT CAST(t.vin AS VARCHAR) AS vin, v.vintype, make_timestamp((epoch_us(ts) // 1000) * 1000) AS ts,
              CASE WHEN event_id % 89 = 0 THEN NULL ELSE (temp_min + temp_avg + temp_max) / 3 END AS temp_avg,
              CASE WHEN event_id % 89 = 0 THEN NULL ELSE 3 END AS n_temps, 2 AS n_cells
       FROM tele t LEFT JOIN vehicles v ON t.vin = v.vin)"""


@register("raw_records_b", f"""{_RAW_B_SQL}
SELECT vin, vintype, ts, CAST(ts AS DATE) AS day, n_cells, n_temps, {S.r6('temp_avg')} AS temp_avg FROM rb""")
def q_raw_records_b(spark, sf_dir):
    """Schema B (79 fields): list fields to numeric arrays (F3, null when an
    item is not a number), their sizes (F4) and the temperature list mean (A14)."""
    b = raw.parse_schema_b(fixture.raw_lines_b(spark, sf_dir))
    size = lambda c: F.when(F.col(c).isNotNull(), F.size(c))
    return b.select("vin", "vintype", "ts", "day", size("cell_volt_list").alias("n_cells"),
                    size("temp_list").alias("n_temps"), r6("temp_avg").alias("temp_avg"))


@register("list_means", f"""{_RAW_B_SQL}
SELECT vin, {S.r6('avg(temp_avg)')} AS temp_list_mean, count(temp_avg) AS n_rows FROM rb GROUP BY vin""")
def q_list_means(spark, sf_dir):
    """Per vehicle the mean of per-row temperature-list means, ignoring missing lists."""
    b = raw.parse_schema_b(fixture.raw_lines_b(spark, sf_dir))
    return b.groupBy("vin").agg(r6(F.avg("temp_avg")).alias("temp_list_mean"),
                                F.count("temp_avg").alias("n_rows"))


# ---------------------------------------------------------------- profiles
# Header-config stand-in: (No, Column, Type) rows as the reference's config file holds them.
PROFILE_CONFIG = [
    {"No": 0, "Column": "soc", "Type": "numeric"},
    {"No": 1, "Column": "speed", "Type": "numerical"},
    {"No": 2, "Column": "volt", "Type": "numeric"},
    {"No": 3, "Column": "brake_pedal", "Type": "categorical"},
    {"No": 4, "Column": "lat", "Type": None},
]


@register("profile_by_day", f"""{S.WITH_TELE}
SELECT day, column_name AS "column", stat, category, value FROM (
  SELECT day, 'soc' AS column_name, 'avg' AS stat, CAST(NULL AS VARCHAR) AS category, {S.r6('avg(soc)')} AS value FROM tele GROUP BY day
  UNION ALL SELECT day, 'soc', 'max', NULL, {S.r6('max(soc)')} FROM tele GROUP BY day
  UNION ALL SELECT day, 'soc', 'min', NULL, {S.r6('min(soc)')} FROM tele GROUP BY day
  UNION ALL SELECT day, 'speed', 'avg', NULL, {S.r6('avg(speed)')} FROM tele GROUP BY day
  UNION ALL SELECT day, 'speed', 'max', NULL, {S.r6('max(speed)')} FROM tele GROUP BY day
  UNION ALL SELECT day, 'speed', 'min', NULL, {S.r6('min(speed)')} FROM tele GROUP BY day
  UNION ALL SELECT day, 'volt', 'avg', NULL, {S.r6('avg(volt)')} FROM tele GROUP BY day
  UNION ALL SELECT day, 'volt', 'max', NULL, {S.r6('max(volt)')} FROM tele GROUP BY day
  UNION ALL SELECT day, 'volt', 'min', NULL, {S.r6('min(volt)')} FROM tele GROUP BY day
  UNION ALL SELECT day, 'brake_pedal', 'count', brake_pedal, CAST(count(*) AS DOUBLE) FROM tele GROUP BY day, brake_pedal)""")
def q_profile_by_day(spark, sf_dir):
    """A16 + S6 config: stats chosen by each column's declared type
    (numeric/numerical -> avg, max, min; categorical -> histogram; untyped skipped)."""
    from ..sources.schemas import stat_plan_from_header_config
    return profile.profile(tele(spark, sf_dir), stat_plan_from_header_config(PROFILE_CONFIG), keys=("day",))


@register("describe_signals", f"""{S.WITH_TELE}
SELECT * FROM (""" + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS count, {S.r6(f'avg({c})')} AS mean, {S.r6(f'stddev_samp({c})')} AS std,
        {S.r6(f'min({c})')} AS min, {S.r6(f'quantile_cont({c}, 0.25)')} AS q25, {S.r6(f'quantile_cont({c}, 0.5)')} AS q50,
        {S.r6(f'quantile_cont({c}, 0.75)')} AS q75, {S.r6(f'max({c})')} AS max FROM tele""" for c in ("soc", "speed", "curr")) + ")")
def q_describe_signals(spark, sf_dir):
    """Describe (count, mean, std, min, quartiles, max) of SOC, speed, current."""
    return profile.describe(tele(spark, sf_dir), ["soc", "speed", "curr"])


@register("speed_histogram", f"""{S.WITH_TELE}
SELECT CAST(floor((speed - 0) / 10) AS BIGINT) AS bin, count(*) AS n,
       CAST(CAST(floor((speed - 0) / 10) AS BIGINT) * 10.0 + 0 AS DOUBLE) AS bin_lo
FROM tele WHERE speed IS NOT NULL GROUP BY 1""")
def q_speed_histogram(spark, sf_dir):
    """Distribution of speed in 10-unit bins."""
    return profile.histogram(tele(spark, sf_dir), "speed", 0.0, 10.0)


@register("speed_current_relation", f"""{S.WITH_TELE}
SELECT vin, count(CASE WHEN speed IS NOT NULL AND curr IS NOT NULL THEN 1 END) AS n,
       {S.r6('corr(speed, curr)')} AS corr, {S.r6('covar_samp(speed, curr)')} AS covar,
       {S.r6('regr_slope(curr, speed)')} AS slope, {S.r6('regr_intercept(curr, speed)')} AS intercept
FROM tele GROUP BY vin""")
def q_speed_current_relation(spark, sf_dir):
    """Per-vehicle relation of current to speed (correlation, covariance, line)."""
    return profile.pair_relation(tele(spark, sf_dir), "speed", "curr", keys=("vin",))


@register("soc_speed_bins", f"""{S.WITH_TELE}
SELECT CAST(floor(soc / 10) AS BIGINT) AS bx, CAST(floor(speed / 25) AS BIGINT) AS by, count(*) AS n
FROM tele WHERE soc IS NOT NULL AND speed IS NOT NULL GROUP BY 1, 2""")
def q_soc_speed_bins(spark, sf_dir):
    """2-D bin counts of SOC against speed."""
    return profile.joint_bins(tele(spark, sf_dir), "soc", "speed", 10.0, 25.0)


@register("vintype_counts", f"""{S.WITH_TELE}
SELECT vintype, count(*) AS n FROM tele JOIN vehicles USING (vin) GROUP BY vintype""")
def q_vintype_counts(spark, sf_dir):
    """A10 + J1: records per vehicle type, most frequent first."""
    return profile.value_counts(tele(spark, sf_dir).join(fixture.vehicles(spark, sf_dir), "vin"), "vintype")


@register("vehicle_days", f"""{S.WITH_TELE} SELECT DISTINCT vin, day FROM tele""")
def q_vehicle_days(spark, sf_dir):
    """A5: distinct (vehicle, day) pairs."""
    return profile.distinct_values(tele(spark, sf_dir), ["vin", "day"])


@register("period_time_bounds", f"""SELECT min(start_time) AS first_start, max(end_time) AS last_end FROM
(SELECT start_time, end_time FROM ({_per_sql('charging')}) a UNION ALL SELECT start_time, end_time FROM ({_per_sql('driving')}) b)""")
def q_period_time_bounds(spark, sf_dir):
    """A24 + U1: first start and last end across charging and driving periods."""
    return profile.time_bounds(_both(spark, sf_dir))


@register("period_positions", f"""SELECT vin, period_no, end_time,
  CAST(row_number() OVER (PARTITION BY vin ORDER BY end_time, period_no) - 1 AS INTEGER) AS position
FROM ({_per_sql('charging')}) p""")
def q_period_positions(spark, sf_dir):
    """Position of each charging period after sorting a vehicle's periods by end time."""
    p = _per(spark, sf_dir, "charging").select("vin", "period_no", "end_time")
    return profile.positions(p, ["vin"], ["end_time", "period_no"])


@register("last_records", f"""{S.WITH_TELE}
SELECT vin, ts, event_id, soc FROM (SELECT *, row_number() OVER (PARTITION BY vin ORDER BY ts DESC, event_id DESC) AS rn
FROM tele) WHERE rn <= 10""")
def q_last_records(spark, sf_dir):
    """Each vehicle's last 10 records."""
    t = tele(spark, sf_dir).select("vin", "day", "ts", "event_id", "soc")
    return profile.last_records(t, ["vin"], 10, ["ts", "event_id"]).drop("day")


@register("active_vehicles", f"""SELECT DISTINCT vin FROM (SELECT vin FROM ({_per_sql('charging')}) a
UNION ALL SELECT vin FROM ({_per_sql('driving')}) b)""")
def q_active_vehicles(spark, sf_dir):
    """Vehicles with charging or driving periods (union of distinct keys)."""
    return profile.union_keys(_both(spark, sf_dir))


# ---------------------------------------------------------------- K9 / F10-F12 (bulk-index documents)
@register("trip_index_documents", f"""{S.WITH_TELE}, {_TRIP_ROWS},
a AS (SELECT vin, trip_no, count(*) AS n_records,
             arg_min(ts, (ts, event_id)) AS start_time, arg_max(ts, (ts, event_id)) AS end_time,
             arg_min(lat, (ts, event_id)) AS start_latitude, arg_min(lon, (ts, event_id)) AS start_longitude,
             arg_max(lat, (ts, event_id)) AS end_latitude, arg_max(lon, (ts, event_id)) AS end_longitude,
             CAST(COALESCE(sum(CASE WHEN abs(step) < 10 THEN step END), 0) AS DOUBLE) AS signed
      FROM t GROUP BY vin, trip_no HAVING count(*) > 1)
SELECT vin, trip_no, '{{"index":{{"_index":"trips","_type":"doc"}}}}' || chr(10) ||
  to_json(struct_pack(vin := vin, trip_no := trip_no, n_records := n_records,
    start_time := strftime(start_time, '%Y-%m-%d %H:%M:%S'), end_time := strftime(end_time, '%Y-%m-%d %H:%M:%S'),
    distance := {S.r6('abs(signed)')},
    start_location := struct_pack(lat := start_latitude, lon := start_longitude),
    end_location := struct_pack(lat := end_latitude, lon := end_longitude))) AS value
FROM a""")
def q_trip_index_documents(spark, sf_dir):
    """K9 + F10-F12: trips as bulk-index lines (action line, then the document
    with typed numbers and nested start/end locations)."""
    tr = trips.trips(tele(spark, sf_dir), max_gap_s=FIXTURE_TRIP_GAP_S).select(
        "vin", "trip_no", "n_records", "start_time", "end_time", "distance",
        F.col("start_lat").alias("start_latitude"), F.col("start_lon").alias("start_longitude"),
        F.col("end_lat").alias("end_latitude"), F.col("end_lon").alias("end_longitude"))
    return export.documents(tr, "trips", keep=("vin", "trip_no"))


_ALL_KINDS = " UNION ALL ".join(f"SELECT * FROM ({q}) x{i}" for i, q in enumerate((
    S.period_stats_sql(S.charging("0"), FIXTURE_PERIOD_GAP_S, 120, 1), S.period_stats_sql(S.on_battery(), FIXTURE_PERIOD_GAP_S, 120, 3),
    S.period_stats_sql(_POLAR_FLAG, FIXTURE_PERIOD_GAP_S, 60, 5, None, 1.0))))


@register("periods_of_all_kinds", _ALL_KINDS)
def q_periods_of_all_kinds(spark, sf_dir):
    """B9 of kinds 1, 3 and 5 in one pass over the records; charging rows belong to two of them."""
    return periods.periods_of(tele(spark, sf_dir), ("charging", "driving", "polarization"), max_gap_s=FIXTURE_PERIOD_GAP_S)


# ---------------------------------------------------------------- B14, B15, B17, B8 charge SOC ranges
@register("missing_time_treatments", f"""{_CHG_ROWS},
m0 AS (SELECT *, lag(ts) OVER w AS lts, soc - lag(soc) OVER w AS dsoc, count(*) OVER (PARTITION BY vin, period_no) AS np,
              abs(last(soc) OVER wa - first(soc) OVER wa) AS span_soc
       FROM r WINDOW w AS (PARTITION BY vin, period_no ORDER BY ts, event_id),
                     wa AS (PARTITION BY vin, period_no ORDER BY ts, event_id
                            ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
m1 AS (SELECT *, {S.gap('lts', 'ts')} AS dt0,
              CASE WHEN span_soc > 0 THEN 2.5 * np * 10 / span_soc END AS thr FROM m0),
m2 AS (SELECT *, CASE WHEN dt0 > 120 AND COALESCE(dsoc / dt0 < 0.001, false) THEN 10 ELSE dt0 END AS dfix,
              CASE WHEN thr IS NOT NULL AND dt0 > thr THEN 10 ELSE dt0 END AS dcur FROM m1),
mg AS (SELECT vin, period_no, count(*) AS count_records, COALESCE(sum(dfix), 0) + 10 AS rf,
             COALESCE(sum(dcur), 0) + 10 AS rc, sum(abs(curr)) AS ithr FROM m2 GROUP BY ALL)
SELECT vin, period_no, count_records, {S.r6('rf')} AS real_s_fixed, {S.r6('rc')} AS real_s_current,
       {S.r6('ithr * 10 / 3600.0 * rf / (count_records * 10)')} AS ah_throughput_fixed_comp,
       {S.r6('ithr * 10 / 3600.0 * rc / (count_records * 10)')} AS ah_throughput_current_comp
FROM mg""")
def q_missing_time_treatments(spark, sf_dir):
    """B14 + B15 + B12: charging-period durations corrected by a fixed
    offset with a SOC-slope limit and by a current-dependent threshold, and
    the Ah throughput compensated by each."""
    return periods.missing_time_treatments(tele(spark, sf_dir), "charging", max_gap_s=FIXTURE_PERIOD_GAP_S)


# ---------------------------------------------------------------- end to end from text (S1-S3 -> A1)
_RAW_TELE = """SELECT CAST(vin AS VARCHAR) AS vin, event_id, make_timestamp((epoch_us(ts) // 1000) * 1000) AS ts,
  CAST(make_timestamp((epoch_us(ts) // 1000) * 1000) AS DATE) AS day, soc, CAST(odo AS DOUBLE) AS odo, charge_cur,
  CAST(charge_st AS DOUBLE) AS charge_st, fuel, volt, curr, lat, lon, speed, temp_avg, temp_max, temp_min,
  cell_volt_max, cell_volt_min, acc_pedal, brake_pedal, charge_volt FROM tele WHERE event_id % 97 <> 0 AND event_id % 107 <> 0"""
_RAW_TELE_B = """SELECT CAST(vin AS VARCHAR) AS vin, event_id, make_timestamp((epoch_us(ts) // 1000) * 1000) AS ts,
  CAST(make_timestamp((epoch_us(ts) // 1000) * 1000) AS DATE) AS day, soc, CAST(odo AS DOUBLE) AS odo,
  CASE WHEN charge_st = 1 THEN abs(curr) ELSE CAST(0 AS DOUBLE) END AS charge_cur, CAST(charge_st AS DOUBLE) AS charge_st, fuel, volt,
  curr, lat, lon, speed, CASE WHEN event_id % 89 = 0 THEN NULL ELSE (temp_min + temp_avg + temp_max) / 3 END AS temp_avg,
  temp_max, temp_min, cell_volt_max, cell_volt_min, acc_pedal, brake_pedal, volt AS charge_volt FROM tele"""


@register("raw_daily_stats", S.stat_row_sql("strftime(ts, '%Y-%m-%d')", source_cte=_RAW_TELE))
def q_raw_daily_stats(spark, sf_dir):
    """S1-S3 + P5-P8 + A1/B8: the daily stat rows computed straight from
    schema-A text lines (the reference's daily job end to end): malformed
    lines, lines without a time and lines delivered twice among them."""
    return stats.daily_stats(raw.parse_schema_a(fixture.raw_lines_a(spark, sf_dir)), dedupe=True)


@register("raw_daily_stats_b", S.stat_row_sql("strftime(ts, '%Y-%m-%d')", source_cte=_RAW_TELE_B))
def q_raw_daily_stats_b(spark, sf_dir):
    """The daily stat rows from schema-B (national-standard) text lines."""
    return stats.daily_stats(raw.stat_columns_b(raw.parse_schema_b(fixture.raw_lines_b(spark, sf_dir))), dedupe=True)


@register("raw_hourly_stats_b", S.stat_row_sql("strftime(date_trunc('hour', ts), '%Y-%m-%d %H:00:00')", hourly=True, source_cte=_RAW_TELE_B))
def q_raw_hourly_stats_b(spark, sf_dir):
    """R10 from schema-B text lines."""
    return stats.hourly_stats(raw.stat_columns_b(raw.parse_schema_b(fixture.raw_lines_b(spark, sf_dir))), dedupe=True)


_RAW_WITH = S.WITH_TELE.replace("WITH tele AS (", "WITH tele0 AS (", 1) + f", tele AS ({_RAW_TELE.replace('FROM tele ', 'FROM tele0 ')})"


@register("raw_trips", ORACLE["trips"].replace(S.WITH_TELE, _RAW_WITH))
def q_raw_trips(spark, sf_dir):
    """B1 from schema-A text lines, of which some have no time or come twice."""
    recs = raw.duplicates_dropped(raw.parse_schema_a(fixture.raw_lines_a(spark, sf_dir)))
    return trips.trips(recs, max_gap_s=FIXTURE_TRIP_GAP_S)


# ---------------------------------------------------------------- P9, P10, P15, P16, P19, W16
_FEW_VINS = (1, 2, 3, 5, 8, 13, 21, 34, 55, 89)


@register("signal_window", f"""{S.WITH_TELE}
SELECT vin, event_id, CAST(soc AS BIGINT) AS soc, curr,
       {S.r6("date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) + (hour(ts) * 3600 + minute(ts) * 60 + second(ts)) / 86400.0")} AS day_number
FROM tele WHERE day BETWEEN DATE '2024-01-10' AND DATE '2024-02-20' AND vin IN {_FEW_VINS} AND curr <> 0 AND soc > 1e-6
  AND cell_volt_min > 1e-6 AND cell_volt_max >= cell_volt_min AND temp_avg > 1e-6 AND temp_max > 1e-6 AND temp_min > 1e-6""")
def q_signal_window(spark, sf_dir):
    """P9 + P10 + P15 + P16 + P19 + W16: plausible records of some vehicles in a
    date range with a non-zero current, SOC as an integer, time in days."""
    t = columns.for_vehicles(columns.in_date_range(tele(spark, sf_dir), "2024-01-10", "2024-02-20"), _FEW_VINS)
    t = columns.integral(t.where(P.plausible() & P.nonzero_current()), "soc")
    return t.select("vin", "event_id", "soc", "curr", r6(day_fraction("ts")).alias("day_number"))


@register("text_times", f"""{S.WITH_TELE}
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS t, CAST(ts AS DATE) AS t_date, strftime(ts, '%H:%M:%S') AS t_time FROM tele""")
def q_text_times(spark, sf_dir):
    """An offset cut off a text time, then its date and time of day."""
    t = tele(spark, sf_dir).select("event_id", F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit("+08:00")).alias("t"))
    return columns.split_date_time(columns.strip_utc_offset(t, ["t"]), "t")


# ---------------------------------------------------------------- F13, J7, P22, R5-R8 on the ledger's rules
def _day_counts(spark, sf_dir):
    return publish.day_counts(tele(spark, sf_dir))


@register("pending_days", f"""{S.WITH_TELE}, done AS (SELECT DISTINCT day FROM tele WHERE day < DATE '2024-02-01')
SELECT CAST(d AS DATE) AS day FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-04-10', INTERVAL 1 DAY)) AS d)
WHERE CAST(d AS DATE) NOT IN (SELECT day FROM done)""")
def q_pending_days(spark, sf_dir):
    """F13 + J7 + R5: the days of a range that the ledger does not mark done."""
    done = _day_counts(spark, sf_dir).where(F.col("day") < F.lit("2024-02-01").cast("date"))
    ledger = done.select(F.lit("j").alias("job"), "day", F.lit("done").alias("status"))
    return publish.pending_days(publish.day_range(spark, "2024-01-01", "2024-04-10"), ledger, "j")


@register("newer_records", f"""{S.WITH_TELE} SELECT day, count(*) AS n_rows FROM tele WHERE day > DATE '2024-03-10' GROUP BY day""")
def q_newer_records(spark, sf_dir):
    """P22 + R7 + K13: rows per day after the ledger's last published day."""
    ledger = _day_counts(spark, sf_dir).where(F.col("day") <= F.lit("2024-03-10").cast("date")).select(
        F.lit("j").alias("job"), "day", F.lit("done").alias("status"))
    return publish.day_counts(publish.newer_than_mark(tele(spark, sf_dir), ledger, "j"))


@register("stat_document_rows", ORACLE["monthly_rollup"])
def q_stat_document_rows(spark, sf_dir):
    """K7 + S10: monthly rows made into stat documents (JSON text) and read back."""
    long = rollup.monthly_rollup(stats.daily_stats(tele(spark, sf_dir)))
    docs = rollup.stat_documents(long.withColumn("vin", F.col("vin").cast("string")))
    text = docs.select(F.to_json(F.struct(*docs.columns)).alias("value"))
    back = rollup.long_form(text.select(F.from_json("value", rollup.DOC_SCHEMA).alias("d")).select("d.*"))
    return back.withColumn("vin", F.col("vin").cast("long"))


@register("document_empty_fields", f"""{S.WITH_TELE}
SELECT event_id, '{{"index":{{"_index":"records","_type":"doc"}}}}' || chr(10) || '{{"event_id":' || event_id ||
  CASE WHEN charge_st IS NULL THEN '' ELSE ',"charge_st":' || charge_st END ||
  CASE WHEN brake_pedal = '0' THEN '' ELSE ',"brake":"' || brake_pedal || '"' END || '}}' AS value FROM tele""")
def q_document_empty_fields(spark, sf_dir):
    """null and empty fields are left out of a document; zero stays."""
    t = tele(spark, sf_dir).select("event_id", "charge_st", F.when(F.col("brake_pedal") == "0", F.lit("")).otherwise(F.col("brake_pedal")).alias("brake"))
    return export.documents(t.withColumn("id", F.col("event_id")).select("id", *t.columns), "records", keep=("id",)).select(
        F.col("id").alias("event_id"), F.regexp_replace("value", r'"id":\d+,', "").alias("value"))


@register("merged_month", ORACLE["monthly_rollup"])
def q_merged_month(spark, sf_dir):
    """J10 + R1-R4 + R6: all days of the table merged in their order into the monthly state, a day
    at a time; the state is a written table after each month."""
    daily = reliable_checkpoint(stats.daily_stats(tele(spark, sf_dir)).select("vin", "day", *history.VALUES))
    lo, hi = daily.agg(F.min("day"), F.max("day")).first()
    state = spark.createDataFrame([], jobs.MONTHLY_SCHEMA.replace("vin string", "vin bigint"))
    day = lo
    while lo is not None and day <= hi:
        state = rollup.merge_day(state, daily, day.isoformat())
        if day.day % 8 == 0:
            state = reliable_checkpoint(state)
        day += dt.timedelta(days=1)
    return state.withColumn("value", r6("value"))


@register("brake_pedal_histogram", f"""{S.WITH_TELE}
SELECT vin, day, 'brake_pedal' AS "column", 'count' AS stat, brake_pedal AS category,
       CAST(count(*) AS DOUBLE) AS value
FROM tele GROUP BY vin, day, brake_pedal""")
def q_brake_pedal_histogram(spark, sf_dir):
    """B8 catStat_brake_pedal (A16 categorical): brake-pedal state counts per vehicle-day."""
    return profile.profile(tele(spark, sf_dir), {"brake_pedal": ("histogram",)}, keys=("vin", "day"))


# ---------------------------------------------------------------- rolling months from daily sketches
_SIGNALS = {"speed": (0.0, 2.5), "curr": (-50.0, 10.0), "soc": (0.0, 10.0)}
_ROLLING_SQL = f"""{S.WITH_TELE},
v AS (SELECT vin, day, unnest([{', '.join(f"{{'signal': '{c}', 'x': CAST({c} AS DOUBLE), 'bin': CAST(floor(({c} - CAST({lo} AS DOUBLE)) / CAST({w} AS DOUBLE)) AS BIGINT)}}" for c, (lo, w) in _SIGNALS.items())}]) AS e FROM tele),
ends AS (SELECT DISTINCT day AS d FROM tele)"""


@register("rolling_signals", f"""{_ROLLING_SQL}
SELECT d AS day, e.signal AS signal, count(e.x) AS n, {S.r6('avg(e.x)')} AS mean, {S.r6('min(e.x)')} AS low, {S.r6('max(e.x)')} AS high,
       count(DISTINCT vin) AS vehicles
FROM ends JOIN v ON v.day <= d AND v.day > d - 30 GROUP BY d, e.signal""")
def q_rolling_signals(spark, sf_dir):
    """A5 + A15 over the last 30 days of each day, from daily sketches: exact figures and the
    number of vehicles."""
    days = sketches.daily(tele(spark, sf_dir), _SIGNALS)
    return sketches.rolling(days, list(_SIGNALS)).drop("q25", "q50", "q75")


@register("rolling_histogram", f"""{_ROLLING_SQL}
SELECT d AS day, e.signal AS signal, e.bin AS bin, count(*) AS n FROM ends JOIN v ON v.day <= d AND v.day > d - 30
WHERE e.bin IS NOT NULL GROUP BY d, e.signal, e.bin""")
def q_rolling_histogram(spark, sf_dir):
    """A17 over the last 30 days of each day, from daily counts of bins."""
    return sketches.rolling_histogram(sketches.daily(tele(spark, sf_dir), _SIGNALS))
