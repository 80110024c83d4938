"""Trips on battery found from the SOC curve.

Reference semantics, per vehicle, on driving rows with no fuel and SOC > 40
(P14 notebook variant). Rows are scanned from the newest to the oldest
(time, then odometer, both descending). The ending date defaults to the date
of the newest row.

* state 0: a row with ``dn_min <= SOC <= dn_max`` opens a candidate when its
  date is the ending date; on any other date the whole scan stops.
* state 1: a row joins when ``SOC - previous SOC > -1`` (going back in time
  SOC may not fall by 1 or more); a joined SOC >= ``up_min`` marks the
  candidate complete. Otherwise the candidate is saved if complete, the row
  is consumed and the scan returns to state 0.
* at the end of the data a complete candidate is saved.

Composition used here (no walk, no window over a vehicle's records): call a row
a *drop* when its SOC is at least 1 below the previous row of the scan. Drops cut
a day's rows into pieces. The scan is an automaton with the states open, complete,
closed and stopped, and a piece acts on it as a function of the state at its
entry; two results per piece are enough, one for an opener at its first row and
one for an opener at a later row, and they are aggregated inside (vehicle, day),
one row per piece. The functions are then composed along a vehicle's pieces:

* A candidate lasts from its opener to the end of its run of pieces. On the
  ending date a piece holds an opener iff ``a or (b and not opener of the piece
  before)``, where ``b`` says the piece's first row is eligible and ``a`` that a
  later row is (a drop row that ends a candidate is consumed). Pieces with ``b
  and not a`` toggle the previous value, so the recurrence has a closed form: the
  parity of the chain of toggling pieces since the last other one.
* Rows of another date open nothing: an eligible row there stops the scan, if it
  is met in the closed state. So no trip starts if a later date has an eligible
  row, and earlier dates only prolong the ending date's last piece: by their
  first pieces, day by day, until a drop lies between two days or inside one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions.scalar import r6

# Fixed values of the reference.
WINDOW_UP_MIN = 90
WINDOW_DN_MIN = 60
WINDOW_DN_MAX = 70
SOC_RECHARGE_OFFSET = 1
MIN_SOC = 40


def battery_rows(df: DataFrame, min_soc: float = MIN_SOC) -> DataFrame:
    """Input of B5: driving rows with fuel rate exactly 0 and SOC above ``min_soc``."""
    return df.where(P.on_battery(min_soc, fuel_eps=None))


def soc_trips(df: DataFrame, up_min: float = WINDOW_UP_MIN, dn_min: float = WINDOW_DN_MIN,
              dn_max: float = WINDOW_DN_MAX, ending_date: Column | None = None,
              offset: float = SOC_RECHARGE_OFFSET) -> DataFrame:
    """B5 over battery rows (see :func:`battery_rows`): one row per trip with
    ``vin, start_time, end_time, start_soc, end_soc, max_soc, n_records``."""
    rows = df.select("vin", "day", "ts", "event_id", "soc", F.coalesce(F.col("odo").cast("double"), F.lit(-1e300)).alias("_odo_k"))
    drop = lambda soc, newer: newer.isNotNull() & ~F.coalesce(soc - newer > -offset, F.lit(False))
    w = Window.partitionBy("vin", "day").orderBy(F.col("ts").desc(), F.col("_odo_k").desc(), F.col("event_id").desc())
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    # pieces of a day: cut at drops; inside a piece, the rows from its first later eligible row on
    rows = rows.withColumn("_newer", F.lag("soc").over(w)).withColumn("_cut", (F.row_number().over(w) == 1) | drop(F.col("soc"), F.col("_newer")))
    rows = rows.withColumn("_elig", F.coalesce(F.col("soc").between(dn_min, dn_max), F.lit(False)))
    rows = rows.withColumn("_piece", F.sum(F.col("_cut").cast("long")).over(run) - 1)
    rows = rows.withColumn("_met", F.sum((F.col("_elig") & ~F.col("_cut")).cast("long")).over(run))
    rows = rows.withColumn("_met", F.col("_met") - F.last(F.when(F.col("_cut"), F.col("_met")), ignorenulls=True).over(run))
    opener = F.col("_elig") & ~F.col("_cut") & (F.col("_met") == 1)
    key = F.struct("ts", "_odo_k", "event_id")
    in_b = F.col("_met") >= 1
    one = F.struct("ts", "soc")
    pieces = rows.groupBy("vin", "day", "_piece").agg(
        F.max(F.col("_cut") & F.col("_elig")).alias("b"), F.max(F.col("_elig") & ~F.col("_cut")).alias("a"), F.max("_elig").alias("any_elig"),
        F.count(F.lit(1)).alias("n_a"), F.max(F.when(~F.col("_cut"), F.col("soc"))).alias("max_a"), F.max_by(one, F.when(F.col("_cut"), key)).alias("open_a"),
        F.count_if(in_b).alias("n_b"), F.max(F.when(in_b & ~opener, F.col("soc"))).alias("max_b"), F.max_by(one, F.when(opener, key)).alias("open_b"),
        F.max("soc").alias("max_all"), F.min_by(one, key).alias("oldest"), F.max_by("soc", key).alias("newest_soc"))

    # the ending date of each vehicle; an eligible row after it stops the scan
    wv = Window.partitionBy("vin")
    pieces = pieces.withColumn("_end", F.max("day").over(wv) if ending_date is None else ending_date.cast("date"))
    pieces = pieces.withColumn("_stopped", F.max((F.col("day") > F.col("_end")) & F.col("any_elig")).over(wv))
    pieces = pieces.where((F.col("day") <= F.col("_end")) & ~F.col("_stopped"))

    # earlier days that prolong the last piece of the ending date: their first pieces up to a drop
    order = Window.partitionBy("vin").orderBy(F.col("day").desc(), "_piece")
    pieces = pieces.withColumn("_before", F.lag("oldest").over(order)).withColumn("_last", F.lead("day").over(order).isNull() | (F.lead("day").over(order) != F.col("day")))
    earlier = F.col("day") < F.col("_end")
    broken = earlier & ((F.col("_piece") > 0) | drop(F.col("newest_soc"), F.col("_before.soc")))
    pieces = pieces.withColumn("_on", earlier & (F.sum(broken.cast("long")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) == 0))
    tail = lambda agg, x: agg(F.when(F.col("_on"), x)).over(wv)
    pieces = pieces.withColumns({"_tail_n": F.coalesce(tail(F.sum, F.col("n_a")), F.lit(0)), "_tail_max": tail(F.max, F.col("max_all")),
                                 "_tail_oldest": F.min(F.when(F.col("_on"), F.struct(F.col("day"), F.col("oldest").alias("o")))).over(wv)})

    # the ending date: which pieces hold an opener
    runs = pieces.where(F.col("day") == F.col("_end"))
    wr = Window.partitionBy("vin").orderBy("_piece")
    upto = wr.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = runs.withColumn("_toggle", ~F.col("a") & F.col("b"))
    runs = runs.withColumn("_last_nt", F.max(F.when(~F.col("_toggle"), F.col("_piece"))).over(upto))
    runs = runs.withColumn("_v0", F.coalesce(F.last(F.when(~F.col("_toggle"), F.col("a")), ignorenulls=True).over(upto), F.lit(False)))
    k = F.col("_piece") - F.coalesce(F.col("_last_nt"), F.lit(-1))
    runs = runs.withColumn("_has", F.when(F.col("_toggle"), F.col("_v0") != (k % 2 == 1)).otherwise(F.col("a")))
    at_first = F.col("b") & ~F.coalesce(F.lag("_has").over(wr), F.lit(False))
    trips = runs.withColumn("_at_first", at_first).where("_has")
    pick = lambda x, y: F.when(F.col("_at_first"), F.col(x)).otherwise(F.col(y))
    on = F.col("_last") & (F.col("_tail_n") > 0)
    oldest = F.when(on, F.col("_tail_oldest.o")).otherwise(F.col("oldest"))
    newest = pick("open_a", "open_b")
    trips = trips.select("vin", oldest["ts"].alias("start_time"), newest["ts"].alias("end_time"), oldest["soc"].alias("start_soc"), newest["soc"].alias("end_soc"),
                         F.greatest(pick("max_a", "max_b"), F.when(on, F.col("_tail_max"))).alias("max_soc"),
                         (pick("n_a", "n_b") + F.when(on, F.col("_tail_n")).otherwise(F.lit(0))).alias("n_records"))
    return (trips.where(F.coalesce(F.col("max_soc") >= up_min, F.lit(False)))
            .select("vin", "start_time", "end_time", r6("start_soc").alias("start_soc"),
                    r6("end_soc").alias("end_soc"), r6("max_soc").alias("max_soc"), "n_records"))
