"""Telemetry stand-in built from the provided ``events`` table.

No vehicle telemetry ships with the test data, so this view maps each event to
one signal record (columns of FIXTURES.md section 3, plus the signals that the
daily statistics need and that section 3 does not define; those extra
expressions are ours). It only shapes rows into the canonical schema of
:mod:`ampwise.sources.schemas`; all analytics run in the operators.

The same expressions exist as DuckDB SQL (:data:`TELEMETRY_SQL`) so the oracle
queries read identical input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BASE_TS = "2024-01-01 00:00:00"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical telemetry rows (one per event) for the fixture tables."""
    ev = load(spark, sf_dir, "events")
    k = F.regexp_extract("props", r"([0-9]+)", 1).cast("bigint")
    # The events cover one month; elapsed time is tripled so that records
    # cross month ends. The odometer is a closed form of the row: time since
    # the base at 0.4 units an hour (whole units, so it repeats), a jump on
    # every 101st event and an invalid zero on every 211th.
    base = F.lit(BASE_TS).cast("timestamp_ntz")
    ev = ev.withColumn("k", k).withColumn("ts", F.col("ts") + (F.col("ts") - base) * 2)
    ev = ev.withColumn("us", F.timestamp_diff("MICROSECOND", base, F.col("ts")))
    odo = F.when(F.col("event_id") % 211 == 0, F.lit(0)).otherwise(
        (F.col("user_id") % 50) * 1000 + 1 + F.expr("us div 9000000000") + F.when(F.col("event_id") % 101 == 0, F.lit(500)).otherwise(F.lit(0)))
    d = lambda x: F.lit(x).cast("double")
    return ev.select(
        F.col("user_id").alias("vin"),
        "event_id",
        "ts",
        F.col("ts").cast("date").alias("day"),
        F.col("k").cast("double").alias("soc"),
        odo.cast("bigint").alias("odo"),
        F.when(F.col("event_type") == "error", F.lit(None).cast("double"))
         .when(F.col("event_type") == "signup", d(16.0)).otherwise(d(0.0)).alias("charge_cur"),
        F.when(F.col("event_type") == "view", F.lit(None).cast("int"))
         .when(F.col("event_type") == "purchase", F.lit(1)).otherwise(F.lit(0)).alias("charge_st"),
        F.when(F.col("event_type") == "click", d(0.0)).otherwise(F.col("value") / 10).alias("fuel"),
        (F.lit(300) + F.col("k")).cast("double").alias("volt"),
        (F.col("value") - 40).alias("curr"),
        (d(23) + (F.col("event_id") % 7) * d(0.0001) + (F.col("user_id") % 20) * d(0.05)).alias("lat"),
        (d(113) + (F.col("event_id") % 5) * d(0.0001)).alias("lon"),
        # signals beyond FIXTURES.md section 3 (ours)
        (F.col("value") / 4).alias("speed"),
        (F.lit(20) + F.col("k") % 15).cast("double").alias("temp_avg"),
        (F.lit(22) + F.col("k") % 17).cast("double").alias("temp_max"),
        (F.lit(18) + F.col("k") % 13).cast("double").alias("temp_min"),
        ((F.lit(390) + F.col("k") % 10).cast("double") / 100).alias("cell_volt_max"),
        ((F.lit(380) + F.col("event_id") % 10).cast("double") / 100).alias("cell_volt_min"),
        ((F.col("k") * 7) % 100).cast("double").alias("acc_pedal"),
        (F.col("event_id") % 3).cast("string").alias("brake_pedal"),
        (F.lit(380) + F.col("k") % 20).cast("double").alias("charge_volt"),
    )


def vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicle dimension (vin, vintype) from ``customer``."""
    return load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("vin"), F.col("c_mktsegment").alias("vintype"))


# DuckDB form of :func:`telemetry`, used by the oracle queries.
TELEMETRY_SQL = """
  SELECT user_id AS vin, event_id, ts, CAST(ts AS DATE) AS day,
         CAST(k AS DOUBLE) AS soc,
         CAST(CASE WHEN event_id % 211 = 0 THEN 0 ELSE (user_id % 50) * 1000 + 1 + us // 9000000000
              + CASE WHEN event_id % 101 = 0 THEN 500 ELSE 0 END END AS BIGINT) AS odo,
         CASE event_type WHEN 'error' THEN NULL WHEN 'signup' THEN CAST(16.0 AS DOUBLE)
              ELSE CAST(0.0 AS DOUBLE) END AS charge_cur,
         CASE event_type WHEN 'view' THEN NULL WHEN 'purchase' THEN 1 ELSE 0 END AS charge_st,
         CASE WHEN event_type = 'click' THEN CAST(0.0 AS DOUBLE) ELSE value / 10 END AS fuel,
         CAST(300 + k AS DOUBLE) AS volt,
         value - 40 AS curr,
         CAST(23 AS DOUBLE) + (event_id % 7) * CAST(0.0001 AS DOUBLE)
           + (user_id % 20) * CAST(0.05 AS DOUBLE) AS lat,
         CAST(113 AS DOUBLE) + (event_id % 5) * CAST(0.0001 AS DOUBLE) AS lon,
         value / 4 AS speed,
         CAST(20 + k % 15 AS DOUBLE) AS temp_avg,
         CAST(22 + k % 17 AS DOUBLE) AS temp_max,
         CAST(18 + k % 13 AS DOUBLE) AS temp_min,
         CAST(390 + k % 10 AS DOUBLE) / 100 AS cell_volt_max,
         CAST(380 + event_id % 10 AS DOUBLE) / 100 AS cell_volt_min,
         CAST((k * 7) % 100 AS DOUBLE) AS acc_pedal,
         CAST(event_id % 3 AS VARCHAR) AS brake_pedal,
         CAST(380 + k % 20 AS DOUBLE) AS charge_volt
  FROM (SELECT * REPLACE (make_timestamp(epoch_us(ts) + 2 * (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00'))) AS ts),
               3 * (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) AS us,
               CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events)
"""

VEHICLES_SQL = "SELECT c_custkey AS vin, c_mktsegment AS vintype FROM customer"


# ---------------------------------------------------------------- raw text stand-ins
RAW_TZ_OFFSET_MS = 8 * 3600 * 1000   # local clock of the raw files is UTC+8 (no DST)
FILE_LAG = "2 hours"                 # a record lands in the file of date(ts + 2 h)


def _txt(c):
    return F.coalesce(c.cast("string"), F.lit(""))


def _epoch_ms(ts="ts"):
    us = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(ts))
    return F.floor(us / 1000).cast("long") - F.lit(RAW_TZ_OFFSET_MS)


def raw_lines_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schema A text lines (``value``) with the day of the file they sit in
    (``file_day``). Lines carry 86 or 85 fields; every 97th event is cut to
    84 fields (malformed), every 107th has no time, every 103rd is delivered
    twice."""
    from .schemas import SCHEMA_A_FIELDS
    t = telemetry(spark, sf_dir)
    time = F.when(F.col("event_id") % 107 == 0, F.lit("null")).otherwise(_txt(_epoch_ms()))
    src = {"VIN": F.col("vin"), "TDATE": time, "SDATE": F.date_format("ts", "yyyyMMdd"),
           "BMS_BATTCURR": F.col("curr"), "BMS_BATTVOLT": F.col("volt"),
           "BMS_CELLVOLTMAX": F.col("cell_volt_max"), "BMS_CELLVOLTMIN": F.col("cell_volt_min"),
           "BMS_BATTSOC": F.col("soc"), "BMS_BATTTEMPAVG": F.col("temp_avg"),
           "BMS_BATTTEMPMAX": F.col("temp_max"), "BMS_BATTTEMPMIN": F.col("temp_min"),
           "CCS_CHARGEVOLT": F.col("charge_volt"), "CCS_CHARGECUR": F.col("charge_cur"),
           "EMS_ACCPEDALPST": F.col("acc_pedal"), "EMS_BRAKEPEDALST": F.col("brake_pedal"),
           "HCU_AVGFUELCONSUMP": F.col("fuel"), "HCU_BATCHRGDSP": F.col("charge_st"),
           "BCS_VEHSPD": F.col("speed"), "ICM_TOTALODOMETER": F.col("odo"),
           "LON84": F.col("lon"), "LAT84": F.col("lat")}
    by_pos = {i: src[name] for i, name in SCHEMA_A_FIELDS.items()}
    fields = F.array(*[_txt(by_pos[i]) if i in by_pos else F.lit("") for i in range(86)])
    n = (F.when(F.col("event_id") % 97 == 0, F.lit(84))
          .when(F.col("event_id") % 2 == 1, F.lit(85)).otherwise(F.lit(86)))
    times = F.when(F.col("event_id") % 103 == 0, F.lit(2)).otherwise(F.lit(1))
    lines = t.select(F.array_join(F.slice(fields, 1, n), ",").alias("value"),
                     F.to_date(F.col("ts") + F.expr(f"INTERVAL {FILE_LAG}")).alias("file_day"), times.alias("times"))
    return lines.select(F.explode(F.array_repeat("value", F.col("times"))).alias("value"), "file_day")


def raw_lines_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schema B text lines (79 fields) with ``|``-separated cell-voltage and
    temperature lists; every 89th event has a non-numeric list item."""
    from .schemas import SCHEMA_B_FIELDS
    t = telemetry(spark, sf_dir).join(vehicles(spark, sf_dir), "vin", "left")
    temps = F.when(F.col("event_id") % 89 == 0,
                   F.concat_ws("|", _txt(F.col("temp_min")), F.lit("x"), _txt(F.col("temp_max")))) \
             .otherwise(F.concat_ws("|", _txt(F.col("temp_min")), _txt(F.col("temp_avg")), _txt(F.col("temp_max"))))
    src = {"vin": F.col("vin"), "vintype": F.col("vintype"), "ts": _epoch_ms(),
           "veh_charge_st": F.col("charge_st"), "veh_runmode": F.lit(1), "veh_spd": F.col("speed"),
           "veh_odo": F.col("odo"), "veh_volt": F.col("volt"), "veh_curr": F.col("curr"),
           "veh_soc": F.col("soc"), "veh_acce_pedal": F.col("acc_pedal"), "veh_brake_pedal": F.col("brake_pedal"),
           "eng_consumption": F.col("fuel"), "data_batt_sc_volt_highest": F.col("cell_volt_max"),
           "data_batt_sc_volt_lowest": F.col("cell_volt_min"), "data_batt_temp_highest": F.col("temp_max"),
           "data_batt_temp_lowest": F.col("temp_min"), "esd_volt": F.col("volt"), "esd_curr": F.col("curr"),
           "esd_sc_volt_list": F.concat_ws("|", _txt(F.col("cell_volt_min")), _txt(F.col("cell_volt_max"))),
           "esd_sc_temp_list": temps}
    by_pos = {i: src[name] for i, name in SCHEMA_B_FIELDS.items()}
    fields = [_txt(by_pos[i]) if i in by_pos else F.lit("") for i in range(79)]
    return t.select(F.concat_ws(",", *fields).alias("value"),
                    F.to_date(F.col("ts") + F.expr(f"INTERVAL {FILE_LAG}")).alias("file_day"))
