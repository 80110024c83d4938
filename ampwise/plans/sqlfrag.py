"""SQL fragments for the DuckDB oracle queries (mirrors of the column helpers)."""

from __future__ import annotations

from ..sources.fixture import TELEMETRY_SQL, VEHICLES_SQL

WITH_TELE = f"WITH tele AS ({TELEMETRY_SQL}), vehicles AS ({VEHICLES_SQL})"

DRIVING = ("(COALESCE(odo > 0, false) AND COALESCE(charge_cur IS NULL OR charge_cur < 0.1, false) "
           "AND COALESCE(charge_st IS NULL OR charge_st = 0, false))")


def charging(threshold: str = "0") -> str:
    return f"COALESCE(charge_cur > {threshold}, false)"


def on_battery(min_soc: int = 20) -> str:
    return (f"({DRIVING} AND COALESCE(fuel < CAST(0.000001 AS DOUBLE), false) "
            f"AND COALESCE(soc > {min_soc}, false))")


def r6(expr: str, digits: int = 6) -> str:
    p = 10 ** digits
    return f"CAST(floor(CAST({expr} AS DOUBLE) * {p} + 0.50001) / {p} AS DOUBLE)"


def avg6(x: str) -> str:
    return f"(sum(CAST(round({x} * 1000000) AS BIGINT)) / count({x}) / 1000000)"


def sum6(x: str) -> str:
    return f"(sum(CAST(round({x} * 1000000) AS BIGINT)) / 1000000)"


def gap(prev: str, cur: str) -> str:
    return f"((epoch_us({cur}) - epoch_us({prev})) // 1000000)"


def duration_text(t: str) -> str:
    return (f"(CASE WHEN {t} < 60 THEN printf('%02ds', {t}) "
            f"WHEN {t} < 3600 THEN printf('%02dm%02ds', {t} // 60, {t} % 60) "
            f"ELSE printf('%dh%02dm%02ds', {t} // 3600, ({t} % 3600) // 60, {t} % 60) END)")


NUM_STATS_SQL = {
    "fuel_efficiency": "fuel",
    "speed_diff": "speed_diff",
    "cell_volt_diff": "cvd",
    "soc": "soc",
    "acc_pedal": "acc_pedal",
    "battery_volt": "volt",
}


def stat_row_sql(label_expr: str, hourly: bool = False, source_cte: str | None = None) -> str:
    """Oracle of :func:`ampwise.operators.stats.period_stats`."""
    kwh = "* 10 / 3600 / 1000"
    num_l1 = ",\n".join(
        f"sum({e}) AS {n}__s, count({e}) AS {n}__n, max({e}) AS {n}__max, min({e}) AS {n}__min"
        for n, e in NUM_STATS_SQL.items())
    num_l2 = ",\n".join(
        f"sum({n}__s) AS {n}__s, sum({n}__n) AS {n}__n, max({n}__max) AS {n}__max, min({n}__min) AS {n}__min"
        for n in NUM_STATS_SQL)
    num_out = ",\n".join(
        f"{r6(f'{n}__s / {n}__n')} AS {n}_avg, {r6(f'{n}__max')} AS {n}_max, {r6(f'{n}__min')} AS {n}_min"
        for n in NUM_STATS_SQL)
    summed = ("n n_valid small big n_fuel fsmall bseg_abs speed_sum speed_n n_chg n_drv n_cstart chg_kwh "
              "thr_kwh cap_ah temp_sum temp_n fuel_cons elec_kwh bat_kwh").split()
    l2 = ", ".join(f"sum({c}) AS {c}" for c in summed)
    hours = "* 10 / 3600.0"
    signed = "CAST(COALESCE(small, 0) AS DOUBLE)"
    fsigned = "CAST(COALESCE(fsmall, 0) AS DOUBLE)"
    dob = "CAST(bseg_abs AS DOUBLE)"
    cols_all = f"""
  CAST(n AS BIGINT) AS n_records,
  {r6(f'CASE WHEN n_valid > 0 THEN abs({signed}) END')} AS distance_driven,
  {r6(f'CASE WHEN n_valid > 0 THEN CAST(COALESCE(big, 0) AS DOUBLE) * sign({signed}) END')} AS odometer_offset,
  {r6(dob)} AS distance_on_battery,
  {r6(f'CASE WHEN n_fuel > 0 THEN abs({fsigned}) END')} AS distance_on_fuel,
  {r6('speed_sum / speed_n')} AS speed_average,
  CAST(speed_n AS BIGINT) AS speed_n,
  {r6('speed_max')} AS speed_max,
  CAST(n_cstart AS BIGINT) AS charged_times,
  {r6('COALESCE(chg_kwh, 0.0)')} AS charged_energy,
  {r6(f'n_chg {hours}')} AS charging_hours,
  {r6(f'n_drv {hours}')} AS driving_hours,
  {r6('COALESCE(thr_kwh, 0.0)')} AS energy_throughput,
  {r6('COALESCE(cap_ah, 0.0)')} AS battery_capacity,
  {r6('temp_sum / temp_n')} AS battery_temp_avg,
  {r6('temp_max')} AS battery_temp_max,
  {r6('temp_min')} AS battery_temp_min,
  {r6('COALESCE(fuel_cons, 0.0)')} AS cum_fuel_consumption,
  {r6('COALESCE(elec_kwh, 0.0)')} AS cum_elec_energy_consumption,
  {r6(f'CASE WHEN {dob} > 0 THEN COALESCE(bat_kwh, 0.0) / {dob} END')} AS elec_energy_efficiency,
  {num_out}"""
    if hourly:
        final = "vin, time_label, n_records, distance_driven, speed_average, speed_n, charging_hours, driving_hours, charged_energy, CAST(CAST(time_label AS TIMESTAMP) AS DATE) AS day"
    else:
        final = "*, CAST(time_label AS DATE) AS day"
    src = "tele"
    head = WITH_TELE
    if source_cte:
        head, src = f"{WITH_TELE}, tsrc AS ({source_cte})", "tsrc"
    return f"""{head},
f AS (SELECT *, {label_expr} AS time_label, {DRIVING} AS _drv, {charging('0')} AS _chg,
             {on_battery()} AS _bat, COALESCE(odo > 0, false) AND ts IS NOT NULL AS _valid FROM {src}),
f2 AS (SELECT *, _drv AND NOT _bat AS _fuelrow FROM f),
w1 AS (SELECT *, lag(_bat) OVER w AS pv_bat, lag(speed) OVER w AS pv_speed,
         last(CASE WHEN _valid THEN odo END IGNORE NULLS) OVER wp AS pv_odo,
         last(CASE WHEN _fuelrow AND _valid THEN odo END IGNORE NULLS) OVER wp AS pv_fodo,
         last(CASE WHEN _bat THEN odo END IGNORE NULLS) OVER wp AS pv_bodo,
         last(CASE WHEN _chg THEN ts END IGNORE NULLS) OVER wp AS pv_cts
       FROM f2 WINDOW w AS (PARTITION BY vin, time_label ORDER BY ts, event_id),
         wp AS (PARTITION BY vin, time_label ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
w2 AS (SELECT *, CASE WHEN _bat AND NOT COALESCE(pv_bat, false) THEN 1 ELSE 0 END AS bstart FROM w1),
w3 AS (SELECT *, SUM(bstart) OVER (PARTITION BY vin, time_label ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) - bstart AS bseg,
         CASE WHEN _valid THEN odo - pv_odo END AS step,
         CASE WHEN _fuelrow AND _valid THEN odo - pv_fodo END AS fstep,
         CASE WHEN _bat THEN odo - pv_bodo END AS bstep,
         _chg AND COALESCE({gap('pv_cts', 'ts')} > 600, true) AS cstart,
         speed - pv_speed AS speed_diff, cell_volt_max - cell_volt_min AS cvd
       FROM w2),
l1 AS (SELECT vin, time_label, bseg, count(*) AS n, count_if(_valid) AS n_valid,
         sum(CASE WHEN abs(step) < 10 THEN step END) AS small,
         sum(CASE WHEN abs(step) >= 10 THEN step END) AS big,
         count_if(_fuelrow AND _valid) AS n_fuel,
         sum(CASE WHEN abs(fstep) < 10 THEN fstep END) AS fsmall,
         abs(COALESCE(sum(CASE WHEN abs(bstep) < 10 THEN bstep END), 0)) AS bseg_abs,
         sum(speed) AS speed_sum, count(speed) AS speed_n, max(speed) AS speed_max,
         count_if(_chg) AS n_chg, count_if(_drv) AS n_drv, count_if(cstart) AS n_cstart,
         sum(CASE WHEN _chg THEN charge_volt * charge_cur {kwh} END) AS chg_kwh,
         sum(abs(curr) * volt {kwh}) AS thr_kwh,
         sum(abs(curr) * 10 / 3600) AS cap_ah,
         sum(temp_avg) AS temp_sum, count(temp_avg) AS temp_n, max(temp_max) AS temp_max, min(temp_min) AS temp_min,
         sum(fuel * (CASE WHEN abs(fstep) < 10 THEN fstep END) / 100) AS fuel_cons,
         sum(CASE WHEN curr > 0 THEN curr * volt {kwh} END) AS elec_kwh,
         sum(CASE WHEN _bat AND curr > 0 THEN curr * volt {kwh} END) AS bat_kwh,
         {num_l1}
       FROM w3 GROUP BY vin, time_label, bseg),
l2 AS (SELECT vin, time_label, {l2}, max(speed_max) AS speed_max, max(temp_max) AS temp_max,
         min(temp_min) AS temp_min, {num_l2}
       FROM l1 GROUP BY vin, time_label),
res AS (SELECT vin, time_label, {cols_all} FROM l2)
SELECT {final} FROM res"""


def _polar_split(drop: float | None) -> str:
    if drop is None:
        return "t AS (SELECT * FROM t0)"
    pb = f"(qts IS NULL OR COALESCE(qcvm - cell_volt_max > {drop}, false))"
    return f"""t AS (SELECT * REPLACE (
        CAST(SUM(CASE WHEN {pb} THEN 1 ELSE 0 END) OVER (PARTITION BY vin ORDER BY ts, event_id
             ROWS UNBOUNDED PRECEDING) - 1 AS BIGINT) AS period_no,
        CASE WHEN {pb} THEN NULL ELSE qts END AS qts, CASE WHEN {pb} THEN NULL ELSE qodo END AS qodo,
        CASE WHEN {pb} THEN NULL ELSE qsoc END AS qsoc, CASE WHEN {pb} THEN NULL ELSE qcur END AS qcur) FROM t0)"""


def period_rows_sql(flag_sql: str, gap_s: int, compaction_s: int = 120, polar_drop: float | None = None) -> str:
    """CTEs ``d, g, b, t, r`` labelling period rows (oracle of label_periods)."""
    return f"""
d AS (SELECT * FROM tele WHERE {flag_sql}),
g AS (SELECT *, lag(ts) OVER w AS pts, lag(odo) OVER w AS podo, lag(soc) OVER w AS psoc,
             lag(curr) OVER w AS pcur, lag(cell_volt_max) OVER w AS pcvm
      FROM d WINDOW w AS (PARTITION BY vin ORDER BY ts, event_id)),
b AS (SELECT *, CASE WHEN pts IS NOT NULL AND {gap('pts', 'ts')} > {gap_s} THEN 1 ELSE 0 END AS brk FROM g),
t0 AS (SELECT *, CAST(SUM(brk) OVER (PARTITION BY vin ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS period_no,
             CASE WHEN brk = 0 THEN pts END AS qts, CASE WHEN brk = 0 THEN podo END AS qodo,
             CASE WHEN brk = 0 THEN psoc END AS qsoc, CASE WHEN brk = 0 THEN pcur END AS qcur,
             CASE WHEN brk = 0 THEN pcvm END AS qcvm FROM b),
{_polar_split(polar_drop)},
r AS (SELECT *, CASE WHEN {gap('qts', 'ts')} > {compaction_s} THEN 10 ELSE {gap('qts', 'ts')} END AS dtc,
             soc - qsoc AS soc_step,
             CASE WHEN qodo IS NOT NULL AND COALESCE(odo > 0, false) THEN odo - qodo END AS step FROM t)"""


def period_stats_sql(flag_sql: str, gap_s: int, compaction_s: int = 120, kind: int = 1,
                     where: str | None = None, polar_drop: float | None = None) -> str:
    z = "CAST(0 AS DOUBLE)"
    h = "* 10 / 3600.0"
    ads = "abs(end_soc - start_soc)"
    norm = lambda x: f"CASE WHEN {ads} <> 0 THEN {x} / {ads} * 100 END"
    secs = gap('start_time', 'end_time')
    sel = f"""
SELECT vin, period_no, count_records, start_time, end_time, CAST(end_time AS DATE) AS day,
  {r6('start_soc')} AS start_soc, {r6('end_soc')} AS end_soc, {r6('end_soc - start_soc')} AS delta_soc,
  {r6(secs + ' / 3600.0')} AS duration,
  {r6(f'_ich {h}')} AS ah_charged, {r6(f'_idis {h}')} AS ah_discharged,
  {r6(f'_ithr {h}')} AS ah_throughput, {r6(f'_icons {h}')} AS ah_consumption,
  {r6(f'_pch {h} / 1000')} AS kwh_charged, {r6(f'_pdis {h} / 1000')} AS kwh_discharged,
  {r6(f'_pthr {h} / 1000')} AS kwh_throughput, {r6(f'_pcons {h} / 1000')} AS kwh_consumption,
  {r6(norm(f'_ithr {h}'))} AS normalized_ah_throughput,
  {r6(norm(f'_icons {h}'))} AS normalized_ah_consumption,
  {r6(norm(f'_pthr {h} / 1000'))} AS normalized_kwh_throughput,
  {r6(norm('distance_driven'))} AS normalized_distance_driven,
  {r6(f'COALESCE(_trap_thr, {z}) / 3600')} AS ah_throughput_trapz,
  {r6(f'COALESCE(_trap_cons, {z}) / 3600')} AS ah_consumption_trapz,
  {r6('_steps_s + 10')} AS real_duration_s,
  {r6(f'_ithr {h} * (_steps_s + 10) / (count_records * 10)')} AS ah_throughput_time_comp,
  {r6(f'CASE WHEN _soc_seen > 0 THEN _ithr {h} * {ads} / _soc_seen END')} AS ah_throughput_soc_comp,
  {r6(f'CASE WHEN {secs} > 0 THEN ({secs} - count_records * 10) / {secs} * 100 END')} AS missing_time_pct,
  {r6('battery_temp_min')} AS battery_temp_min, {r6('battery_temp_max')} AS battery_temp_max,
  {r6('_tavg')} AS battery_temp_avg, {r6('_cvd')} AS cell_volt_diff_mean,
  distance_driven, {kind} AS kind
FROM a"""
    return f"""{WITH_TELE}, {period_rows_sql(flag_sql, gap_s, compaction_s, polar_drop)},
a AS (SELECT vin, period_no, count(*) AS count_records,
        arg_min(ts, (ts, event_id)) AS start_time, arg_max(ts, (ts, event_id)) AS end_time,
        arg_min(soc, (ts, event_id)) AS start_soc, arg_max(soc, (ts, event_id)) AS end_soc,
        sum(greatest(curr, {z})) AS _ich, sum(greatest(-curr, {z})) AS _idis,
        sum(abs(curr)) AS _ithr, sum(curr) AS _icons,
        sum(greatest(curr, {z}) * volt) AS _pch, sum(greatest(-curr, {z}) * volt) AS _pdis,
        sum(abs(curr) * volt) AS _pthr, sum(curr * volt) AS _pcons,
        sum((abs(curr) + abs(qcur)) / 2 * dtc) AS _trap_thr, sum((curr + qcur) / 2 * dtc) AS _trap_cons,
        sum(dtc) AS _steps_s, sum(CASE WHEN abs(soc_step) <= 1 THEN abs(soc_step) END) AS _soc_seen,
        min(temp_min) AS battery_temp_min, max(temp_max) AS battery_temp_max, avg(temp_avg) AS _tavg,
        avg(cell_volt_max - cell_volt_min) AS _cvd,
        CASE WHEN count_if(COALESCE(odo > 0, false)) > 0 THEN
          {r6('abs(CAST(COALESCE(sum(CASE WHEN abs(step) < 10 THEN step END), 0) AS DOUBLE))')} END AS distance_driven
      FROM r GROUP BY vin, period_no HAVING count(*) >= 2),
p AS ({sel})
SELECT * FROM p {('WHERE ' + where) if where else ''}"""


def trunc_text(x: str, n: int) -> str:
    s = f"CAST({x} AS VARCHAR)"
    return (f"(CASE WHEN {x} IS NULL THEN NULL WHEN contains(upper({s}), 'E') THEN printf('%.{n}f', {x}) "
            f"ELSE split_part({s}, '.', 1) || '.' || substr(split_part({s}, '.', 2) || '{'0' * n}', 1, {n}) END)")


def haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (f"(2 * 6371008.8 * asin(sqrt(least(1.0, pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) "
            f"+ cos(radians({lat1})) * cos(radians({lat2})) * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2)))))")


LOOKUP_SQL = ("SELECT printf('%.2f', 23 + (n_nationkey % 20) * CAST(0.05 AS DOUBLE)) AS lat, '113.00' AS lon, "
              "n_nationkey AS seq, n_name AS city, r_name AS province "
              "FROM nation JOIN region ON n_regionkey = r_regionkey")
LOOKUP_FIRST_SQL = (f"SELECT lat, lon, arg_min(city, seq) AS city, arg_min(province, seq) AS province "
                    f"FROM ({LOOKUP_SQL}) GROUP BY lat, lon")


def primary_location_sql(n: int) -> str:
    return f"""{WITH_TELE},
p AS (SELECT vin, ts, event_id, {trunc_text('lat', 2)} AS tlat, {trunc_text('lon', 2)} AS tlon
      FROM tele WHERE lat IS NOT NULL AND lon IS NOT NULL),
q AS (SELECT * FROM p WHERE tlat <> '0.00' AND tlon <> '0.00'),
r AS (SELECT *, row_number() OVER (PARTITION BY vin ORDER BY ts DESC, event_id DESC) AS rn FROM q),
c AS (SELECT vin, tlat || '+' || tlon AS coord, count(*) AS n FROM r WHERE rn <= {n} GROUP BY 1, 2),
m AS (SELECT vin, arg_min(coord, (-n, coord)) AS coord, max(n) AS n_records FROM c GROUP BY vin),
lk AS ({LOOKUP_FIRST_SQL})
SELECT m.vin, split_part(coord, '+', 1) AS lat, split_part(coord, '+', 2) AS lon, n_records, city, province
FROM m LEFT JOIN lk ON split_part(coord, '+', 1) = lk.lat AND split_part(coord, '+', 2) = lk.lon"""


def clusters_sql() -> str:
    """CTEs ``u`` (deduplicated charging rows), ``lab`` (point -> cluster),
    ``cen`` and ``rep`` (A23) for the charging-station oracle."""
    hv = haversine('a.lat', 'a.lon', 'b.lat', 'b.lon')
    return f"""{WITH_TELE},
ch AS (SELECT * FROM tele WHERE COALESCE(charge_cur > 0, false) AND lat IS NOT NULL AND lon IS NOT NULL
         AND charge_volt IS NOT NULL AND charge_cur IS NOT NULL),
g AS (SELECT *, COALESCE({gap('lag(ts) OVER (PARTITION BY vin ORDER BY ts, event_id)', 'ts')}, 10) AS gap_s FROM ch),
d AS (SELECT * FROM g WHERE gap_s > 5),
u AS (SELECT lat, lon, arg_min(vin, (vin, ts, event_id)) AS vin, arg_min(ts, (vin, ts, event_id)) AS ts,
             arg_min(charge_volt, (vin, ts, event_id)) AS charge_volt,
             arg_min(charge_cur, (vin, ts, event_id)) AS charge_cur FROM d GROUP BY lat, lon),
edges AS (SELECT a.lat AS alat, a.lon AS alon, b.lat AS blat, b.lon AS blon FROM u a JOIN u b
          ON (a.lat <> b.lat OR a.lon <> b.lon) AND {hv} <= 20.0),
rc AS (SELECT * FROM (WITH RECURSIVE r(lat, lon, llat, llon) AS (
          SELECT lat, lon, lat, lon FROM u
          UNION SELECT e.blat, e.blon, r.llat, r.llon FROM r JOIN edges e ON r.lat = e.alat AND r.lon = e.alon)
        SELECT * FROM r)),
lab AS (SELECT lat, lon, arg_min(llat, (llat, llon)) AS clat, arg_min(llon, (llat, llon)) AS clon FROM rc GROUP BY lat, lon),
cen AS (SELECT clat, clon, count(*) AS n_points, avg(lat) AS mlat, avg(lon) AS mlon FROM lab GROUP BY clat, clon),
rep AS (SELECT lab.clat, lab.clon, n_points, mlat, mlon,
          arg_min(lat, ({r6(haversine('lat', 'lon', 'mlat', 'mlon'))}, lat, lon)) AS center_lat,
          arg_min(lon, ({r6(haversine('lat', 'lon', 'mlat', 'mlon'))}, lat, lon)) AS center_lon,
          arg_max(lat, ({r6(haversine('lat', 'lon', 'mlat', 'mlon'))}, -lat, -lon)) AS far_lat,
          arg_max(lon, ({r6(haversine('lat', 'lon', 'mlat', 'mlon'))}, -lat, -lon)) AS far_lon,
          max({r6(haversine('lat', 'lon', 'mlat', 'mlon'))}) AS radius_m
        FROM lab JOIN cen ON lab.clat = cen.clat AND lab.clon = cen.clon GROUP BY ALL)"""
