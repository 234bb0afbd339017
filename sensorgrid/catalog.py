"""Column catalog: the role of each known sensor column.

Operators that treat columns differently by name (the grouping policy,
outlier handling, the model drop list) read this table instead of
matching names in code.  Unknown columns fall back to name rules
(``max`` when the name contains ``max``; mean otherwise).
"""

from __future__ import annotations

import re

from dataclasses import dataclass


@dataclass(frozen=True)
class ColumnInfo:
    source_name: str
    alias: str
    agg: str            # mean | circular_mean | last | max | removed | time
    decimals: int | None  # places for un-normalised data; None = as is
    emr: bool = False
    drop_for_model: bool = False


# --- fixed values: must equal the source feeds' column set and policy ------
# (source column name, alias, aggregation, decimals, EMR column, dropped
#  before modelling)
CATALOG: tuple[ColumnInfo, ...] = (
    ColumnInfo("Record Number", "record_number", "removed", None, False, True),
    ColumnInfo("Time", "ts", "time", None),
    ColumnInfo("Temperature (F)", "temperature_f", "mean", 1),
    ColumnInfo("Pressure (mbar)", "pressure_mbar", "mean", 1),
    ColumnInfo("Humidity (%)", "humidity_pct", "mean", 1),
    ColumnInfo("Wind Direction (Degrees)", "wind_dir_deg", "circular_mean", 1),
    ColumnInfo("Wind Direction (String)", "wind_dir_txt", "removed", None, False, True),
    ColumnInfo("Wind Speed (MPH)", "wind_speed_mph", "mean", 1),
    ColumnInfo("Wind Gust (MPH)", "wind_gust_mph", "max", None),
    ColumnInfo("Precipitation (Inches)", "precipitation_in", "last", None),
    ColumnInfo("Shortwave Radiation (W m^(-2))", "shortwave_wm2", "mean", 0, False, True),
    ColumnInfo("Avg. RF Watts (W)", "rf_watts_avg", "mean", 16, True),
    ColumnInfo("Avg. RF Watts Frequency (MHz)", "rf_watts_freq_avg", "mean", 0, True),
    ColumnInfo("Peak RF Watts (W)", "rf_watts_peak", "mean", 16, True),
    ColumnInfo("Frequency of RF Watts Peak (MHz)", "rf_watts_peak_freq", "mean", 0, True),
    ColumnInfo("Peak RF Watts Frequency (MHz)", "rf_watts_freq_peak", "mean", 0, True),
    ColumnInfo("Watts of RF Watts Frequency Peak (W)", "rf_watts_at_freq_peak", "mean", 16, True),
    ColumnInfo("Avg. RF Density (W m^(-2))", "rf_density_avg", "mean", 16, True),
    ColumnInfo("Avg. RF Density Frequency (MHz)", "rf_density_freq_avg", "mean", 0, True),
    ColumnInfo("Peak RF Density (W m^(-2))", "rf_density_peak", "mean", 16, True),
    ColumnInfo("Frequency of RF Density Peak (MHz)", "rf_density_peak_freq", "mean", 0, True),
    ColumnInfo("Peak RF Density Frequency (MHz)", "rf_density_freq_peak", "mean", 0, True),
    ColumnInfo("Density of RF Density Frequency Peak (W m^(-2))", "rf_density_at_freq_peak", "mean", 16, True),
    ColumnInfo("Avg. Total Density (W m^(-2))", "total_density_avg", "mean", 16, True),
    ColumnInfo("Max Total Density (W m^(-2))", "total_density_max", "max", None, True),
    ColumnInfo("Avg. EF (V/m)", "ef_avg", "mean", 1, True),
    ColumnInfo("Max EF (V/m)", "ef_max", "max", None, True),
    ColumnInfo("Avg. EMF (mG)", "emf_avg", "mean", 1, True, True),
    ColumnInfo("Max EMF (mG)", "emf_max", "max", None, True, True),
    ColumnInfo("Station ID", "station_id", "removed", None, False, True),
    ColumnInfo("BeeMonitorID", "monitor_id", "removed", None, False, True),
    ColumnInfo("UpwardMotion", "motion_up", "mean", 0, False, True),
    ColumnInfo("DownwardMotion", "motion_down", "mean", 0, False, True),
    ColumnInfo("LateralMotion", "motion_lateral", "mean", 0, False, True),
    ColumnInfo("TotalMotion", "motion_total", "mean", 0),
    ColumnInfo("Shortwave Radiation USU (MJ/m^2)", "solar_mjm2", "mean", 3),
    ColumnInfo("Month", "month", "mean", 1),
    ColumnInfo("Hour", "hour", "mean", 1),
)
# Interval spans of the trend sweep, in hours (fixed value: 1..24).
TREND_SWEEP_HOURS = tuple(range(1, 25))
# Night limits (fixed values): exploration keeps 07:00 <= t < 21:30,
# modelling keeps 07:00 <= t < 21:00.
NIGHT_END = "07:00"
NIGHT_START_EXPLORE = "21:30"
NIGHT_START_MODEL = "21:00"
# z-score limit for EMR outliers and the 95 % normal quantile (fixed values).
ZSCORE_LIMIT = 3.0
Z95 = 1.959963984540054
# ---------------------------------------------------------------------------

BY_ALIAS = {c.alias: c for c in CATALOG}
BY_SOURCE = {c.source_name: c for c in CATALOG}
TARGET = "motion_total"


def alias_of(name: str) -> str:
    info = BY_SOURCE.get(name)
    return info.alias if info else name


def info_for(name: str) -> ColumnInfo:
    """Catalog entry for an alias or source name; unknown names (trend columns)
    are averaged unless the name holds ``Max`` (or, as an alias, the word
    ``max``)."""
    if name in BY_ALIAS:
        return BY_ALIAS[name]
    if name in BY_SOURCE:
        return BY_SOURCE[name]
    agg = "max" if "Max" in name or re.search(r"(^|_)max($|[_ ])", name) else "mean"
    return ColumnInfo(name, name, agg, 1)


def emr_columns(columns) -> list[str]:
    return [c for c in columns if info_for(c).emr]


def model_drop_list(columns) -> list[str]:
    return [c for c in columns if c in BY_ALIAS and BY_ALIAS[c].drop_for_model]


def id_columns(columns) -> list[str]:
    return [c for c in columns if c in BY_ALIAS and BY_ALIAS[c].agg == "removed"]
