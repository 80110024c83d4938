"""Scalar column functions, all built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the reference.
SAMPLE_SECONDS = 10              # assumed sampling interval of the signal records
EARTH_RADIUS_M = 6371008.8       # mean earth radius used for haversine distances
LOCAL_TZ = "Asia/Hong_Kong"      # local clock of the raw epoch-millisecond times


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def r6(c, digits: int = 6) -> Column:
    """Round to ``digits`` places as ``floor(x * 10^d + 0.50001) / 10^d``.

    Plain IEEE arithmetic, so any engine gives the same double for the same
    input (decimal rounding of the shortest text form does not), and the
    result is never -0.0. The rounding point sits 1e-5 units below the half
    so that values whose exact decimal value is a tie (common with inputs of
    few decimals) are not split by last-bit differences in how two engines
    sum or fit them."""
    p = 10 ** digits
    x = _c(c).cast("double")
    # beyond 9e15 units (or for NaN and infinity) a double has no such places: pass it on
    return F.when(F.abs(x) < 9e15 / p, (F.floor(x * p + 0.50001) / p).cast("double")).otherwise(x)


def avg6(c) -> Column:
    """Mean of values already rounded to 6 places, summed exactly as integer
    micro-units (summation order then cannot change the rounded result)."""
    x = _c(c)
    return F.sum(F.round(x * 1_000_000).cast("long")) / F.count(x) / 1_000_000


def sum6(c) -> Column:
    """Exact sum of values already rounded to 6 places (integer micro-units)."""
    return F.sum(F.round(_c(c) * 1_000_000).cast("long")) / 1_000_000


def duration_text(seconds) -> Column:
    """``05s``, ``02m05s`` or ``1h02m05s`` from a duration in seconds
    (truncated to whole seconds first)."""
    t = F.floor(_c(seconds)).cast("long")
    return (F.when(t < 60, F.format_string("%02ds", t))
            .when(t < 3600, F.format_string("%02dm%02ds", (t / 60).cast("long"), t % 60))
            .otherwise(F.format_string("%dh%02dm%02ds", (t / 3600).cast("long"),
                                       ((t % 3600) / 60).cast("long"), t % 60)))


def truncate_text(x, n: int) -> Column:
    """decimal text of ``x`` cut (not rounded) to ``n`` places, padded with
    zeros; values whose text form has an exponent are rounded to ``n`` places."""
    s = _c(x).cast("string")
    ip = F.substring_index(s, ".", 1)
    frac = F.when(F.instr(s, ".") > 0, F.substring_index(s, ".", -1)).otherwise(F.lit(""))
    cut = F.concat(ip, F.lit("."), F.substring(F.concat(frac, F.lit("0" * n)), 1, n))
    return (F.when(_c(x).isNull(), F.lit(None).cast("string"))
            .when(F.upper(s).contains("E"), F.format_string(f"%.{n}f", _c(x)))
            .otherwise(cut))


def truncate_number(x, n: int) -> Column:
    """F2 numeric path: toward-zero truncation to ``n`` places."""
    p = 10.0 ** n
    return F.signum(_c(x)) * F.floor(F.abs(_c(x)) * p) / p


def list_to_array(x, sep: str = "|") -> Column:
    """``1|2|3`` text to ``array<double>``; null when any item is not a
    number (the reference returns NaN for the whole list) or the text is empty."""
    parts = F.split(_c(x), "[" + sep + "]")
    arr = F.transform(parts, lambda e: e.try_cast("double"))
    bad = F.exists(arr, lambda e: e.isNull())
    return F.when(_c(x).isNull() | (F.trim(_c(x)) == "") | bad, F.lit(None).cast("array<double>")).otherwise(arr)


def array_mean(arr) -> Column:
    """A14 helper: mean of the non-null items of a numeric array (null if none)."""
    vals = F.filter(_c(arr), lambda e: e.isNotNull() & ~F.isnan(e))
    n = F.size(vals)
    tot = F.aggregate(vals, F.lit(0.0), lambda acc, e: acc + e)
    return F.when(n > 0, tot / n)


def coord_key(lat, lon) -> Column:
    """``lat+lon`` key."""
    return F.concat_ws("+", _c(lat), _c(lon))


def haversine_m(lat1, lon1, lat2, lon2) -> Column:
    """great-circle distance in metres."""
    la1, la2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dla = la2 - la1
    dlo = F.radians(_c(lon2)) - F.radians(_c(lon1))
    a = F.pow(F.sin(dla / 2), 2) + F.cos(la1) * F.cos(la2) * F.pow(F.sin(dlo / 2), 2)
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def bucket_upper(x, step: float) -> Column:
    """upper edge of the ``step``-wide bucket holding ``x``."""
    return F.ceil(_c(x) / step) * step


def time_label(ts, freq: str) -> Column:
    """period label of a timestamp: daily ``yyyy-MM-dd``, hourly
    ``yyyy-MM-dd HH:00:00``, monthly ``yyyy-M``."""
    if freq == "daily":
        return F.date_format(_c(ts), "yyyy-MM-dd")
    if freq == "hourly":
        return F.date_format(F.date_trunc("hour", _c(ts)), "yyyy-MM-dd HH:00:00")
    if freq == "monthly":
        return F.concat_ws("-", F.year(_c(ts)).cast("string"), F.month(_c(ts)).cast("string"))
    raise ValueError(freq)


def record_energy_kwh(volt, cur, seconds: float = SAMPLE_SECONDS) -> Column:
    """energy of one record, ``V * I * 10 / 3600 / 1000`` kWh."""
    return _c(volt) * _c(cur) * seconds / 3600 / 1000


def per_full_soc(x, delta_soc) -> Column:
    """normalise to 100 % SOC, null when the SOC change is 0."""
    return F.when(_c(delta_soc) != 0, _c(x) / _c(delta_soc) * 100)


def missing_time_pct(duration_h, n_records, seconds: float = SAMPLE_SECONDS) -> Column:
    """F16 share form: ``(duration - n/360) / duration * 100`` (hours)."""
    exp_h = _c(n_records) * seconds / 3600
    return F.when(_c(duration_h) != 0, (_c(duration_h) - exp_h) / _c(duration_h) * 100)


def missing_time_hours(duration_h, n_records, seconds: float = SAMPLE_SECONDS) -> Column:
    """F16 hours form: ``duration - n * 10 / 3600``."""
    return _c(duration_h) - _c(n_records) * seconds / 3600


def day_fraction(ts) -> Column:
    """Time as fractional days since the epoch (day + seconds/86400)."""
    return (F.unix_date(_c(ts).cast("date")).cast("double")
            + (F.hour(_c(ts)) * 3600 + F.minute(_c(ts)) * 60 + F.second(_c(ts))) / 86400.0)


def epoch_ms_to_local(ms, tz: str = LOCAL_TZ) -> Column:
    """Epoch milliseconds to the local wall-clock ``timestamp_ntz``."""
    utc = F.timestamp_add("MILLISECOND", _c(ms).cast("long"),
                          F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)


def yyyymmdd_to_date(x) -> Column:
    """P8."""
    return F.to_date(_c(x).cast("string"), "yyyyMMdd")


def gap_seconds(prev_ts, ts) -> Column:
    """W1 core: whole elapsed seconds from ``prev_ts`` to ``ts`` (truncated)."""
    us = F.timestamp_diff("MICROSECOND", _c(prev_ts), _c(ts))
    return F.floor(us / 1_000_000).cast("long")
