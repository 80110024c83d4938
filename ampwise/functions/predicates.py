"""Row predicates on canonical telemetry columns.

Each returns a non-null boolean Column (null inputs evaluate to ``False``
where the reference's pandas comparison with NaN is false), so they can be
used both in ``where`` and inside conditional aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed thresholds of the reference.
DRIVING_MAX_CHARGE_CUR = 0.1      # charge current below this is "not charging"
CHARGING_MIN_CUR = 0.0            # location work: current > 0
CHARGING_MIN_CUR_STRICT = 1e-6    # battery notebook: current > 1e-6
FUEL_EPS = 1e-6                   # "no fuel" when fuel rate < 1e-6
MIN_SOC_ON_BATTERY = 20           # battery-only driving needs SOC above this


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _f(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def not_charging(cur="charge_cur", limit: float = DRIVING_MAX_CHARGE_CUR) -> Column:
    """P13 complement: current null or below ``limit``."""
    return _f(_c(cur).isNull() | (_c(cur) < limit))


def driving(odo="odo", cur="charge_cur", st="charge_st") -> Column:
    """Odometer > 0, not charging by current, charge status 0 or null."""
    return (_f(_c(odo) > 0) & not_charging(cur)
            & _f(_c(st).isNull() | (_c(st) == 0)))


def charging(cur="charge_cur", threshold: float = CHARGING_MIN_CUR) -> Column:
    """Charge current above ``threshold`` (0, or 1e-6 in battery work)."""
    return _f(_c(cur) > threshold)


def on_battery(min_soc: float = MIN_SOC_ON_BATTERY, fuel="fuel", soc="soc",
               fuel_eps: float | None = FUEL_EPS) -> Column:
    """Driving with no fuel (< 1e-6, or exactly 0 when ``fuel_eps`` is None)
    and SOC above ``min_soc`` (notebook variant: 40)."""
    nofuel = (_c(fuel) < fuel_eps) if fuel_eps is not None else (_c(fuel) == 0)
    return driving() & _f(nofuel) & _f(_c(soc) > min_soc)


def plausible(soc="soc", cmin="cell_volt_min", cmax="cell_volt_max",
              temps=("temp_avg", "temp_max", "temp_min")) -> Column:
    """P15 outlier filter: SOC, min cell voltage and the three temperatures
    above 1e-6 and max cell voltage >= min cell voltage."""
    c = _f(_c(soc) > 1e-6) & _f(_c(cmin) > 1e-6) & _f(_c(cmax) >= _c(cmin))
    for t in temps:
        c = c & _f(_c(t) > 1e-6)
    return c


def soc_window(delta_min: float = 40, end_min: float = 90,
               delta="delta_soc", end="end_soc") -> Column:
    """Periods with SOC rise above ``delta_min`` ending above ``end_min``."""
    return _f((_c(delta) > delta_min) & (_c(end) > end_min))


def nonzero_current(cur="curr") -> Column:
    """P19."""
    return _f(_c(cur) != 0)


def valid_coordinates(lat="lat", lon="lon") -> Column:
    """P11 on position columns."""
    return _c(lat).isNotNull() & _c(lon).isNotNull()
