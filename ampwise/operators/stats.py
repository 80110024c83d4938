"""Per-vehicle daily and hourly statistics.

One ``groupBy(vin, time_label)`` replaces the reference's grouped shuffle of
raw rows. All stats come from two window passes inside the (vin, period)
group (previous values, then run numbers; both on the same partitioning, so
raw rows are shuffled once) and a two-level aggregation: level 1 groups by
(vin, period, battery-run) so the battery distance (B4) can take the absolute
value of each run's sum, level 2 merges the runs. Neither level needs a
further exchange of raw rows.

Definitions marked *ours* have no body in the reference (SURVEY B8 "N"):

=============================  ==============================================
distance_driven, odometer_offset  B2/B3 over rows with an odometer > 0
distance_on_battery            B4 (runs of battery-driving rows, P14)
distance_on_fuel               B2 over driving rows that are not P14 (ours)
speed_average / speed_n        mean / count of non-null speed (ours)
speed_max                      max speed (ours)
charged_times                  charging periods starting in the group: a
                               charging row whose previous charging row is
                               missing or more than 600 s earlier (ours)
charged_energy                 sum of charge volt x charge current x 10/3600/1000
                               over charging rows (F14)
charging_hours / driving_hours rows x 10 / 3600
energy_throughput              sum |I| x V x 10/3600/1000
battery_capacity               sum |I| x 10/3600 (Ah)
battery_temp_avg/max/min       avg of temp_avg, max of temp_max, min of temp_min (ours)
cum_fuel_consumption           sum fuel rate x odometer step / 100 over fuel
                               driving rows (ours)
cum_elec_energy_consumption    sum I x V x 10/3600/1000 where I > 0 (ours)
elec_energy_efficiency         battery-driving energy (I > 0) / distance on
                               battery, null when that distance is 0 (ours)
<x>_avg/_max/_min              for fuel rate, speed difference, cell voltage
                               difference, SOC, accelerator, battery voltage
=============================  ==============================================
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions.scalar import SAMPLE_SECONDS, gap_seconds, r6, record_energy_kwh, time_label
from .distance import JUMP_THRESHOLD, ORDER, valid_odometer
from .scan import ordered_scan

CHARGE_PERIOD_GAP_S = 600
HOURLY_STATS = ("distance_driven", "speed_average", "speed_n", "charging_hours",
                "driving_hours", "charged_energy")
NUM_STATS = {  # output prefix -> per-row expression
    "fuel_efficiency": lambda: F.col("fuel"),
    "speed_diff": lambda: F.col("speed") - F.col("_pv_speed"),
    "cell_volt_diff": lambda: F.col("cell_volt_max") - F.col("cell_volt_min"),
    "soc": lambda: F.col("soc"),
    "acc_pedal": lambda: F.col("acc_pedal"),
    "battery_volt": lambda: F.col("volt"),
}


def _kwh(x: Column) -> Column:
    return x * SAMPLE_SECONDS / 3600 / 1000


def scan_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ORDER,
              bucket: Column | str | None = None, min_soc: float = P.MIN_SOC_ON_BATTERY) -> DataFrame:
    """Per-row flags and steps shared by every stat (two ordered scans)."""
    valid = valid_odometer()
    s = (df.withColumn("_drv", P.driving())
           .withColumn("_chg", P.charging())
           .withColumn("_bat", P.on_battery(min_soc)))
    s = s.withColumn("_fuelrow", F.col("_drv") & ~F.col("_bat"))
    s = ordered_scan(s, keys, order, bucket,
                     lags={"_pv_bat": F.col("_bat"), "_pv_speed": F.col("speed")},
                     lasts={"_pv_odo": F.when(valid, F.col("odo")),
                            "_pv_fodo": F.when(F.col("_fuelrow") & valid, F.col("odo")),
                            "_pv_bodo": F.when(F.col("_bat"), F.col("odo")),
                            "_pv_cts": F.when(F.col("_chg"), F.col("ts"))})
    s = s.withColumn("_bstart", F.col("_bat") & ~F.coalesce(F.col("_pv_bat"), F.lit(False)))
    s = ordered_scan(s, keys, order, bucket, cums={"_bseg_no": F.col("_bstart").cast("int")})
    return (s.withColumn("_valid", valid)
             .withColumn("_step", F.when(valid, F.col("odo") - F.col("_pv_odo")))
             .withColumn("_fstep", F.when(F.col("_fuelrow") & valid, F.col("odo") - F.col("_pv_fodo")))
             .withColumn("_bstep", F.when(F.col("_bat"), F.col("odo") - F.col("_pv_bodo")))
             .withColumn("_bseg", F.col("_bseg_no") - F.col("_bstart").cast("int"))
             .withColumn("_cstart", F.col("_chg") & F.coalesce(
                 gap_seconds("_pv_cts", "ts") > CHARGE_PERIOD_GAP_S, F.lit(True))))


def _small(c: str, jump) -> Column:
    return F.when(F.abs(F.col(c)) < jump, F.col(c))


def period_stats(df: DataFrame, freq: str | Sequence[str] = "daily", keys: Sequence[str] = ("vin",),
                 order: Sequence[str] = ORDER, bucket: Column | str | None = None,
                 jump: float = JUMP_THRESHOLD, min_soc: float = P.MIN_SOC_ON_BATTERY,
                 dedupe: bool = False) -> DataFrame:
    """B8 stat row per (vin, time_label) for ``freq`` in daily/hourly/monthly.
    Rows without a time are left out. ``dedupe`` drops records equal to the one
    before in ``order`` (a line delivered twice); it uses the windows' own
    partitioning, so it adds no shuffle. Several frequencies give one table with a column
    ``freq`` from one read of ``df``: a row is taken once for each."""
    g = df.where(F.col("ts").isNotNull())
    if isinstance(freq, str):
        g, gk = g.withColumn("time_label", time_label("ts", freq)), [*keys, "time_label"]
    else:
        each = F.explode(F.array(*[F.struct(F.lit(f).alias("freq"), time_label("ts", f).alias("time_label")) for f in freq]))
        g = g.withColumn("_label", each).withColumn("freq", F.col("_label.freq")).withColumn("time_label", F.col("_label.time_label")).drop("_label")
        gk = [*keys, "freq", "time_label"]
    if dedupe:
        this = F.struct(*[F.col(c) for c in order])
        g = g.withColumn("_again", F.coalesce(F.lag(this).over(Window.partitionBy(*gk).orderBy(*order)) == this, F.lit(False)))
        g = g.where(~F.col("_again")).drop("_again")
    s = scan_rows(g, gk, order, bucket, min_soc)
    iv, vv = F.col("curr"), F.col("volt")
    l1 = [
        F.count("*").alias("n"),
        F.count_if("_valid").alias("n_valid"),
        F.sum(_small("_step", jump)).alias("small"),
        F.sum(F.when(F.abs(F.col("_step")) >= jump, F.col("_step"))).alias("big"),
        F.count_if(F.col("_fuelrow") & F.col("_valid")).alias("n_fuel"),
        F.sum(_small("_fstep", jump)).alias("fsmall"),
        F.abs(F.coalesce(F.sum(_small("_bstep", jump)), F.lit(0))).alias("bseg_abs"),
        F.sum("speed").alias("speed_sum"), F.count("speed").alias("speed_n"),
        F.max("speed").alias("speed_max"),
        F.count_if("_chg").alias("n_chg"), F.count_if("_drv").alias("n_drv"),
        F.count_if("_cstart").alias("n_cstart"),
        F.sum(F.when(F.col("_chg"), record_energy_kwh("charge_volt", "charge_cur"))).alias("chg_kwh"),
        F.sum(_kwh(F.abs(iv) * vv)).alias("thr_kwh"),
        F.sum(F.abs(iv) * SAMPLE_SECONDS / 3600).alias("cap_ah"),
        F.sum("temp_avg").alias("temp_sum"), F.count("temp_avg").alias("temp_n"),
        F.max("temp_max").alias("temp_max"), F.min("temp_min").alias("temp_min"),
        F.sum(F.col("fuel") * _small("_fstep", jump) / 100).alias("fuel_cons"),
        F.sum(F.when(iv > 0, _kwh(iv * vv))).alias("elec_kwh"),
        F.sum(F.when(F.col("_bat") & (iv > 0), _kwh(iv * vv))).alias("bat_kwh"),
    ]
    for name, expr in NUM_STATS.items():
        e = expr()
        l1 += [F.sum(e).alias(f"{name}__s"), F.count(e).alias(f"{name}__n"),
               F.max(e).alias(f"{name}__max"), F.min(e).alias(f"{name}__min")]
    lvl1 = s.groupBy(*gk, "_bseg").agg(*l1)

    summed = ["n", "n_valid", "small", "big", "n_fuel", "fsmall", "bseg_abs", "speed_sum", "speed_n",
              "n_chg", "n_drv", "n_cstart", "chg_kwh", "thr_kwh", "cap_ah", "temp_sum", "temp_n",
              "fuel_cons", "elec_kwh", "bat_kwh"]
    l2 = [F.sum(c).alias(c) for c in summed]
    l2 += [F.max("speed_max").alias("speed_max"), F.max("temp_max").alias("temp_max"),
           F.min("temp_min").alias("temp_min")]
    for name in NUM_STATS:
        l2 += [F.sum(f"{name}__s").alias(f"{name}__s"), F.sum(f"{name}__n").alias(f"{name}__n"),
               F.max(f"{name}__max").alias(f"{name}__max"), F.min(f"{name}__min").alias(f"{name}__min")]
    t = lvl1.groupBy(*gk).agg(*l2)

    signed = F.coalesce(F.col("small"), F.lit(0)).cast("double")
    fsigned = F.coalesce(F.col("fsmall"), F.lit(0)).cast("double")
    dob = F.col("bseg_abs").cast("double")
    z = F.lit(0.0)
    out = [
        *gk,
        F.col("n").alias("n_records"),
        r6(F.when(F.col("n_valid") > 0, F.abs(signed))).alias("distance_driven"),
        r6(F.when(F.col("n_valid") > 0, F.coalesce(F.col("big"), F.lit(0)).cast("double")
                  * F.signum(signed))).alias("odometer_offset"),
        r6(dob).alias("distance_on_battery"),
        r6(F.when(F.col("n_fuel") > 0, F.abs(fsigned))).alias("distance_on_fuel"),
        r6(F.col("speed_sum") / F.col("speed_n")).alias("speed_average"),
        F.col("speed_n"),
        r6("speed_max").alias("speed_max"),
        F.col("n_cstart").alias("charged_times"),
        r6(F.coalesce(F.col("chg_kwh"), z)).alias("charged_energy"),
        r6(F.col("n_chg") * SAMPLE_SECONDS / 3600.0).alias("charging_hours"),
        r6(F.col("n_drv") * SAMPLE_SECONDS / 3600.0).alias("driving_hours"),
        r6(F.coalesce(F.col("thr_kwh"), z)).alias("energy_throughput"),
        r6(F.coalesce(F.col("cap_ah"), z)).alias("battery_capacity"),
        r6(F.col("temp_sum") / F.col("temp_n")).alias("battery_temp_avg"),
        r6("temp_max").alias("battery_temp_max"),
        r6("temp_min").alias("battery_temp_min"),
        r6(F.coalesce(F.col("fuel_cons"), z)).alias("cum_fuel_consumption"),
        r6(F.coalesce(F.col("elec_kwh"), z)).alias("cum_elec_energy_consumption"),
        r6(F.when(dob > 0, F.coalesce(F.col("bat_kwh"), z) / dob)).alias("elec_energy_efficiency"),
    ]
    for name in NUM_STATS:
        out += [r6(F.col(f"{name}__s") / F.col(f"{name}__n")).alias(f"{name}_avg"),
                r6(f"{name}__max").alias(f"{name}_max"), r6(f"{name}__min").alias(f"{name}_min")]
    res = t.select(*out)
    if freq == "hourly":
        res = res.select(*gk, "n_records", *HOURLY_STATS)
    return res


def daily_stats(df: DataFrame, **kw) -> DataFrame:
    """Daily stat row with the partition column ``day``."""
    return period_stats(df, "daily", **kw).withColumn("day", F.to_date("time_label"))


def hourly_stats(df: DataFrame, **kw) -> DataFrame:
    """R10 hourly subset with ``day`` derived from the hourly label."""
    return (period_stats(df, "hourly", **kw)
            .withColumn("day", F.to_date(F.to_timestamp("time_label"))))


def state_counts(df: DataFrame, keys: Sequence[str] = ("vin",)) -> DataFrame:
    """Record counts by state (all, charging with current > 1e-6, driving)."""
    return df.groupBy(*keys).agg(
        F.count("*").alias("n_all"),
        F.count_if(P.charging(threshold=P.CHARGING_MIN_CUR_STRICT)).alias("n_charging"),
        F.count_if(P.driving()).alias("n_driving"))
