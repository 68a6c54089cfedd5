"""Column functions: classifications, unit changes and formulas that need one row only."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _steps(c: Column, levels: Iterable[tuple[float, object]], other: object = None, strict: bool = False) -> Column:
    """The value of the first level (falling) that c reaches, or exceeds if strict."""
    out = None
    for level, value in levels:
        test = c > level if strict else c >= level
        out = F.when(test, F.lit(value)) if out is None else out.when(test, F.lit(value))
    return out.otherwise(F.lit(other))


# NO2 rating levels in ug/m3.
NO2_LEVELS = [(340, "extremely poor"), (230, "very poor"), (120, "poor"), (90, "moderate"), (40, "fair"), (0, "good")]
# Medium and high levels of emissions by pollutant.
IMPACT_LEVELS = {"NOx": (60, 120), "CO2": (35000, 70000)}
# Names of road conditions.
ROAD_CONDITIONS = {"RC1": "Dry road", "RC2": "Wet road", "RC3": "Ice / snow on the road", "RC4": "Mix water / snow on the road", "RC5": "Dew", "RC6": "Melting snow", "RC7": "Frost", "RC8": "Icing rain"}
# Mixing height in m and Monin-Obukhov length in m by stability class.
MIXING_HEIGHT = {"A": 1300, "B": 900, "C": 850, "D": 800, "E": 400, "F": 100}
MONIN_OBUKHOV = {"A": -2, "B": -10, "C": -100, "D": 1000, "E": 100, "F": 200}
# Least radiation in W/m2 for classes A, B and C by wind speed up to (m/s); None: the class isn't given there.
DAY_CLASSES = [(2, (540, 270, 140)), (3, (700, 270, 140)), (4, (None, 400, 140)), (5, (None, 540, 270)), (6, (None, None, 270)), (None, (None, None, 540))]
BANDS = (1, 2, 5, 10, 20, 50, 100)  # fixed values: concentration levels


def no2_rating(value: Column) -> Column:
    """Rating of an NO2 value; NULL for negative and missing ones."""
    return _steps(value, NO2_LEVELS)


def emission_impact(pollutant: Column, value: Column) -> Column:
    """High, medium or low; `undefined` for pollutants without levels."""
    out = F.when(value.isNull(), F.lit(None).cast("string"))
    for name, (medium, high) in IMPACT_LEVELS.items():
        out = out.when(pollutant == name, _steps(value, [(high, "high"), (medium, "medium")], "low", strict=True))
    return out.otherwise("undefined")


def remaining(capacity: Column, value: Column) -> Column:
    """Capacity less value, truncated, not below 0; NULL if there is no positive capacity."""
    return F.when(capacity > 0, F.greatest((capacity - value).cast("long"), F.lit(0).cast("long")))


def vehicle_class(name: Column) -> Column:
    """Class of a traffic data type by its name."""
    up = F.upper(name)
    return F.when(up.contains("BUSES"), "BUSES").when(up.contains("HEAVY"), "HEAVY_VEHICLES").when(up.contains("LIGHT"), "LIGHT_VEHICLES")


def code_part(code: Column, i: int) -> Column:
    """Part i (0 road, 1 station, 2 lane) of road:station:lane; NULL unless there are three parts."""
    parts = F.split(code, ":")
    return F.when(F.size(parts) == 3, F.get(parts, F.lit(i)))


def lane_direction(lane: Column) -> Column:
    """Lanes 1, 2, 5 lead north, 3, 4, 6 south."""
    n = lane.cast("int")
    return F.when(n.isin(1, 2, 5), "NORD").when(n.isin(3, 4, 6), "SUD")


def station_km(metadata: Column) -> Column:
    """P10: km from the metre in the embedded JSON of the metadata; -1000 if absent."""
    return F.coalesce(F.get_json_object(F.get_json_object(metadata, "$.a22_metadata"), "$.metro").cast("double") / 1000, F.lit(-1000.0))


# How names of stations tell their direction and lane.
DIRECTION_PATTERN = r"direzione (\w+)\)"
LANE_PATTERN = r"\(corsia di [\w\s]+, "


def direction_of(name: Column) -> Column:
    """The word after `direzione` at the end of the parentheses; empty if there is none."""
    return F.regexp_extract(name, DIRECTION_PATTERN, 1)


def name_without_lane(name: Column) -> Column:
    """The name without what says its lane."""
    return F.regexp_replace(name, LANE_PATTERN, "(")


def speed_kmh(length_m: Column, seconds: Column) -> Column:
    """Speed on a link; NULL where no time passed."""
    return F.try_divide(length_m, seconds) * 3.6


def copert_factor(speed: Column, low: Column, high: Column, alpha: Column, beta: Column, gamma: Column, delta: Column, epsilon: Column, zita: Column, hta: Column, euro: Column, fuel: Column) -> Column:
    """Emission factor at a speed that is held within the limits of the curve."""
    v = F.greatest(F.least(speed, high), low)
    curve = F.try_divide(alpha * v * v + beta * v + gamma + F.try_divide(delta, v), epsilon * v * v + zita * v + hta)
    return curve * (1 - euro) * (1 - fuel)


def signed_slope(slope: Column, lane: Column, has_curves: Column) -> Column:
    """The slope as lanes 1 and 2 drive it; NULL for categories without curves by slope."""
    return F.when(has_curves, F.when(lane.cast("int").isin(1, 2), -slope).otherwise(slope))


def road_condition(state: Column, surface: Column, dew: Column) -> Column:
    """struct<code, confidence> from weather state, surface and dew temperature, where 0 stands for no data."""
    pair = lambda a, b: F.struct(F.lit(a).alias("code"), F.lit(b).alias("confidence"))
    signed = lambda above, below, none: F.when(surface > 0, pair(above, 1)).when(surface < 0, pair(below, 1)).otherwise(pair(none, 0))
    dry = F.when((surface == 0) & (dew == 0), pair(1, 0)).when(surface < dew, pair(5, 1)).otherwise(pair(1, 1))
    return F.when(state.isin(4, 5), signed(2, 8, 2)).when(state == 6, signed(6, 3, 3)).otherwise(dry)


def road_condition_label(name: Column) -> Column:
    """P20: what RC1 to RC8 mean; NULL for other names."""
    out = F.lit(None).cast("string")
    for code, label in ROAD_CONDITIONS.items():
        out = F.when(name == code, label).otherwise(out)
    return out


def missing_zero(value: Column) -> Column:
    """0 as no data."""
    return F.nullif(value, F.lit(0).cast("double"))


def not_negative(value: Column) -> Column:
    """Negative radiation as 0; NULL stays."""
    return F.when(value < 0, 0.0).otherwise(value)


def pg_stability(radiation: Column, wind: Column, ts: Column, missing_radiation: str = "night") -> Column:
    """Pasquill-Gifford class. missing_radiation: `night` or `null`, what a missing radiation is taken for."""
    day = None
    for upto, levels in DAY_CLASSES:
        own = _steps(radiation, [(level, c) for level, c in zip(levels, "ABC") if level is not None], "D")
        test = F.lit(True) if upto is None else (wind <= upto if upto == 2 else wind < upto)
        day = F.when(test, own) if day is None else day.when(test, own)
    month = F.month(ts)
    winter = F.when(wind <= 3, "F").when(wind <= 5, "E").otherwise("D")
    between = F.when(wind <= 2, "F").when(wind <= 3, "E").otherwise("D")
    night = F.when(month.isin(6, 7, 8), "D").when(month.isin(12, 1, 2), winter).otherwise(between)
    out = F.when(radiation > 0, day).otherwise(night)
    return out if missing_radiation == "night" else F.when(radiation.isNotNull(), out)


def _lookup(c: Column, table: dict, other: object) -> Column:
    out = F.lit(other)
    for k, v in table.items():
        out = F.when(c == k, v).otherwise(out)
    return out


def mixing_height(stability: Column) -> Column:
    """P24."""
    return _lookup(stability, MIXING_HEIGHT, -99)


def monin_obukhov(stability: Column) -> Column:
    """P24."""
    return _lookup(stability, MONIN_OBUKHOV, -99)


def net_radiation(radiation: Column, ts: Column) -> Column:
    """P25: half of the radiation by day, a loss by season at night."""
    month = F.month(ts)
    return F.when(radiation > 0, radiation / 2).otherwise(F.when(month.isin(6, 7, 8), -20.0).when(month.isin(12, 1, 2), -40.0).otherwise(-30.0))


def pressure_pa(hpa: Column) -> Column:
    """hPa to Pa, values outside of 700 to 1100 as normal pressure."""
    return F.when((hpa < 700) | (hpa > 1100), 1013.25).otherwise(hpa) * 100


def wind_ms(kmh: Column) -> Column:
    """km/h to m/s, by the rounded factor that the formulas were made with."""
    return kmh * 0.2777777


def water_mm(rain_mm: Column, snow_cm: Column) -> Column:
    """Water of rain and snow at a ratio of ten."""
    return rain_mm + snow_cm / 10 * 10


def hour_slot(ts: Column, slots: int = 24) -> Column:
    """Which of so many equal slots of the day."""
    seconds = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    return F.floor(seconds / (86400 // slots)).cast("int")


def weather_code(letter: Column) -> Column:
    """A to z as 0 to 25."""
    return F.ascii(letter) - 97


def municipality(city: Column, town: Column, village: Column, hamlet: Column) -> Column:
    """The first name that is there."""
    return F.coalesce(city, town, village, hamlet)


def finite(c: Column) -> Column:
    """NaN and infinities as NULL."""
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def concentration_band(value: Column) -> Column:
    """The highest level that is reached; NULL below the first."""
    return _steps(value, [(b, b) for b in reversed(BANDS)])


def mean_angle(degrees: Column) -> Column:
    """Vector mean of directions, 0 to 360 (an aggregate)."""
    r = F.radians(finite(degrees))
    angle = F.degrees(F.atan2(F.avg(F.sin(r)), F.avg(F.cos(r))))
    return F.when(angle < 0, angle + 360).otherwise(angle)
