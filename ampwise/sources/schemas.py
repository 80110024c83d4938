"""Record layouts of the raw signal files.

Raw records are comma-separated text with fields fixed by position. Each
layout maps a field index to the reference's signal name and to the
canonical column the operators use.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values of the reference: schema A (older protocol), field index -> signal name.
SCHEMA_A_FIELDS = {
    0: "VIN", 1: "TDATE", 2: "SDATE", 4: "BMS_BATTCURR", 5: "BMS_BATTVOLT", 8: "BMS_CELLVOLTMAX",
    9: "BMS_CELLVOLTMIN", 11: "BMS_BATTSOC", 12: "BMS_BATTTEMPAVG", 13: "BMS_BATTTEMPMAX",
    14: "BMS_BATTTEMPMIN", 15: "CCS_CHARGEVOLT", 16: "CCS_CHARGECUR", 52: "EMS_ACCPEDALPST",
    53: "EMS_BRAKEPEDALST", 57: "HCU_AVGFUELCONSUMP", 58: "HCU_BATCHRGDSP", 59: "BCS_VEHSPD",
    60: "ICM_TOTALODOMETER", 74: "LON84", 75: "LAT84",
}
SCHEMA_A_LENGTHS = (85, 86)

# Fixed values of the reference: schema B (national-standard protocol).
SCHEMA_B_FIELDS = {
    0: "vin", 1: "vintype", 2: "ts", 4: "veh_charge_st", 5: "veh_runmode", 6: "veh_spd", 7: "veh_odo",
    8: "veh_volt", 10: "veh_curr", 11: "veh_soc", 14: "veh_acce_pedal", 15: "veh_brake_pedal",
    26: "eng_consumption", 32: "data_batt_sc_volt_highest", 35: "data_batt_sc_volt_lowest",
    38: "data_batt_temp_highest", 41: "data_batt_temp_lowest", 72: "esd_volt", 73: "esd_curr",
    77: "esd_sc_volt_list", 78: "esd_sc_temp_list",
}
SCHEMA_B_LENGTHS = (79,)

# signal name -> (canonical column, type)
CANONICAL_A = {
    "VIN": ("vin", "string"), "TDATE": ("ts_ms", "long"), "SDATE": ("sdate", "string"),
    "BMS_BATTCURR": ("curr", "double"), "BMS_BATTVOLT": ("volt", "double"),
    "BMS_CELLVOLTMAX": ("cell_volt_max", "double"), "BMS_CELLVOLTMIN": ("cell_volt_min", "double"),
    "BMS_BATTSOC": ("soc", "double"), "BMS_BATTTEMPAVG": ("temp_avg", "double"),
    "BMS_BATTTEMPMAX": ("temp_max", "double"), "BMS_BATTTEMPMIN": ("temp_min", "double"),
    "CCS_CHARGEVOLT": ("charge_volt", "double"), "CCS_CHARGECUR": ("charge_cur", "double"),
    "EMS_ACCPEDALPST": ("acc_pedal", "double"), "EMS_BRAKEPEDALST": ("brake_pedal", "string"),
    "HCU_AVGFUELCONSUMP": ("fuel", "double"), "HCU_BATCHRGDSP": ("charge_st", "double"),
    "BCS_VEHSPD": ("speed", "double"), "ICM_TOTALODOMETER": ("odo", "double"),
    "LON84": ("lon", "double"), "LAT84": ("lat", "double"),
}
CANONICAL_B = {
    "vin": ("vin", "string"), "vintype": ("vintype", "string"), "ts": ("ts_ms", "long"),
    "veh_charge_st": ("charge_st", "double"), "veh_runmode": ("runmode", "double"),
    "veh_spd": ("speed", "double"), "veh_odo": ("odo", "double"), "veh_volt": ("volt", "double"),
    "veh_curr": ("curr", "double"), "veh_soc": ("soc", "double"), "veh_acce_pedal": ("acc_pedal", "double"),
    "veh_brake_pedal": ("brake_pedal", "string"), "eng_consumption": ("fuel", "double"),
    "data_batt_sc_volt_highest": ("cell_volt_max", "double"),
    "data_batt_sc_volt_lowest": ("cell_volt_min", "double"),
    "data_batt_temp_highest": ("temp_max", "double"), "data_batt_temp_lowest": ("temp_min", "double"),
    "esd_volt": ("esd_volt", "double"), "esd_curr": ("esd_curr", "double"),
    "esd_sc_volt_list": ("cell_volt_list", "list"), "esd_sc_temp_list": ("temp_list", "list"),
}

# header config (No, Column, Type): both spellings occur in the reference
NUMERIC_TYPES = ("numeric", "numerical")
CATEGORICAL_TYPES = ("categorical",)
HEADER_CONFIG_SCHEMA = T.StructType([
    T.StructField("No", T.IntegerType()), T.StructField("Column", T.StringType()),
    T.StructField("Type", T.StringType())])


def struct_from_header_config(rows) -> T.StructType:
    """Build the CSV schema from header-config rows ``(No, Column, Type)``
    (the config is a small driver-side file, read once): numeric types become
    doubles, everything else strings, ordered by ``No``."""
    fields = []
    for r in sorted(rows, key=lambda r: r["No"]):
        typ = (r["Type"] or "").strip().lower()
        fields.append(T.StructField(r["Column"].strip(),
                                    T.DoubleType() if typ in NUMERIC_TYPES else T.StringType()))
    return T.StructType(fields)


def stat_plan_from_header_config(rows) -> dict[str, tuple[str, ...]]:
    """The stats to compute per declared type: numeric -> avg/max/min,
    categorical -> histogram, untyped columns are skipped."""
    plan = {}
    for r in rows:
        typ = (r["Type"] or "").strip().lower()
        if typ in NUMERIC_TYPES:
            plan[r["Column"].strip()] = ("avg", "max", "min")
        elif typ in CATEGORICAL_TYPES:
            plan[r["Column"].strip()] = ("histogram",)
    return plan
