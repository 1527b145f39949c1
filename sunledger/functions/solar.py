"""Sun position as one chain of arithmetic columns.

The earth's heliocentric place is a sum of periodic terms; nutation, aberration, the parallax
of the place and the difference of dynamical and universal time are allowed for, and
refraction is the published correction. Terms that the sum leaves out are below 0.0003
degrees together, so angles agree with a full ephemeris to better than 0.001 degrees.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from sunledger.functions.numeric import rint_round
from sunledger.functions.temporal import epoch_seconds

# The site the angle table is made for, and its clock offset.
SITE_LATITUDE = 23.975128
SITE_LONGITUDE = 121.613275
SITE_UTC_OFFSET_HOURS = 8.0

PRESSURE_HPA = 1013.25
TEMPERATURE_C = 12.0

DELTA_T_SECONDS = 67.0

# Published periodic terms of the earth's place (amplitude, phase, rate per
# thousand years), by power of time; angles in 1e-8 radians, distance in 1e-8 units.
LONGITUDE_TERMS = (
    (
        (175347046.0, 0.0, 0.0),
        (3341656.0, 4.6692568, 6283.07585),
        (34894.0, 4.6261, 12566.1517),
        (3497.0, 2.7441, 5753.3849),
        (3418.0, 2.8289, 3.5231),
        (3136.0, 3.6277, 77713.7715),
        (2676.0, 4.4181, 7860.4194),
        (2343.0, 6.1352, 3930.2097),
        (1324.0, 0.7425, 11506.7698),
        (1273.0, 2.0371, 529.691),
        (1199.0, 1.1096, 1577.3435),
        (990.0, 5.233, 5884.927),
        (902.0, 2.045, 26.298),
        (857.0, 3.508, 398.149),
        (780.0, 1.179, 5223.694),
        (753.0, 2.533, 5507.553),
        (505.0, 4.583, 18849.228),
        (492.0, 4.205, 775.523),
        (357.0, 2.92, 0.067),
        (317.0, 5.849, 11790.629),
        (284.0, 1.899, 796.298),
        (271.0, 0.315, 10977.079),
        (243.0, 0.345, 5486.778),
        (206.0, 4.806, 2544.314),
        (205.0, 1.869, 5573.143),
        (202.0, 2.458, 6069.777),
        (156.0, 0.833, 213.299),
        (132.0, 3.411, 2942.463),
        (126.0, 1.083, 20.775),
        (115.0, 0.645, 0.98),
        (103.0, 0.636, 4694.003),
        (102.0, 0.976, 15720.839),
        (102.0, 4.267, 7.114),
        (99.0, 6.21, 2146.17),
        (98.0, 0.68, 155.42),
        (86.0, 5.98, 161000.69),
        (85.0, 1.3, 6275.96),
        (85.0, 3.67, 71430.7),
        (80.0, 1.81, 17260.15),
        (79.0, 3.04, 12036.46),
        (75.0, 1.76, 5088.63),
        (74.0, 3.5, 3154.69),
        (74.0, 4.68, 801.82),
        (70.0, 0.83, 9437.76),
    ),
    (
        (628331966747.0, 0.0, 0.0),
        (206059.0, 2.678235, 6283.07585),
        (4303.0, 2.6351, 12566.1517),
        (425.0, 1.59, 3.523),
        (119.0, 5.796, 26.298),
        (109.0, 2.966, 1577.344),
    ),
    ((52919.0, 0.0, 0.0), (8720.0, 1.0721, 6283.0758), (309.0, 0.867, 12566.152)),
    ((289.0, 5.844, 6283.076),),
)
LATITUDE_TERMS = (
    (
        (280.0, 3.199, 84334.662),
        (102.0, 5.422, 5507.553),
        (80.0, 3.88, 5223.69),
        (44.0, 3.7, 2352.87),
        (32.0, 4.0, 1577.34),
    ),
)
DISTANCE_TERMS = (
    (
        (100013989.0, 0.0, 0.0),
        (1670700.0, 3.0984635, 6283.07585),
        (13956.0, 3.05525, 12566.1517),
        (3084.0, 5.1985, 77713.7715),
        (1628.0, 1.1739, 5753.3849),
        (1576.0, 2.8469, 7860.4194),
        (925.0, 5.453, 11506.77),
        (542.0, 4.564, 3930.21),
        (472.0, 3.661, 5884.927),
        (346.0, 0.964, 5507.553),
    ),
    ((103019.0, 1.10749, 6283.07585), (1721.0, 1.0644, 12566.1517), (702.0, 3.142, 0.0)),
)
# The main terms of nutation in arc seconds, (argument, in longitude, in obliquity).
NUTATION_TERMS = (
    ("node", -17.1996, 9.2025),
    ("2.0 * sun_mean", -1.3187, 0.5736),
    ("2.0 * moon_mean", -0.2274, 0.0977),
    ("2.0 * node", 0.2062, -0.0895),
    ("sun_anomaly", 0.1426, 0.0054),
    ("moon_anomaly", 0.0712, -0.0007),
    ("2.0 * sun_mean + sun_anomaly", -0.0517, 0.0224),
    ("2.0 * moon_mean - node", -0.0386, 0.02),
)


def _series(powers: Sequence[Sequence[tuple[float, float, float]]]) -> str:
    """The sum of periodic terms, in the table's unit divided by 1e8."""
    sums = []
    for power, terms in enumerate(powers):
        text = " + ".join(f"{a} * cos({b} + {c} * mill)" for a, b, c in terms)
        sums.append("".join("mill * " for _ in range(power)) + f"({text})")
    return f"({' + '.join(sums)}) / 100000000.0"


def _nutation(wave: str, column: int) -> str:
    return "(" + " + ".join(f"({term[column]}) * {wave}({term[0]})" for term in NUTATION_TERMS) + ") / 3600.0"


# Each step may use the names above it; written once as SQL text so that Spark and any other
# SQL engine evaluate the same formula. Angles are radians unless a step says degrees().
STEPS: tuple[tuple[str, str], ...] = (
    ("jd_days", "(sun_epoch_s - utc_offset_h * 3600.0) / 86400.0 - 10957.5"),
    ("cent_ut", "jd_days / 36525.0"),
    ("cent", f"(jd_days + {DELTA_T_SECONDS} / 86400.0) / 36525.0"),
    ("mill", "cent / 10.0"),
    ("helio_lon", _series(LONGITUDE_TERMS)),
    ("helio_lat", _series(LATITUDE_TERMS)),
    ("sun_distance", _series(DISTANCE_TERMS)),
    ("node", "radians(125.04452 - 1934.136261 * cent + 0.0020708 * cent * cent)"),
    ("sun_mean", "radians(280.4665 + 36000.7698 * cent)"),
    ("moon_mean", "radians(218.3165 + 481267.8813 * cent)"),
    ("sun_anomaly", "radians(357.52772 + 35999.05034 * cent)"),
    ("moon_anomaly", "radians(134.96298 + 477198.867398 * cent)"),
    ("nutation_lon", _nutation("sin", 1)),
    ("nutation_obl", _nutation("cos", 2)),
    ("obliq", "radians(23.43929111 - 0.01300417 * cent - 0.00000016 * cent * cent + nutation_obl)"),
    ("ecl_lon", "helio_lon + radians(180.0 + nutation_lon - 20.4898 / (3600.0 * sun_distance))"),
    ("ecl_lat", "-helio_lat"),
    ("right_asc", "atan2(sin(ecl_lon) * cos(obliq) - tan(ecl_lat) * sin(obliq), cos(ecl_lon))"),
    ("declin", "asin(sin(ecl_lat) * cos(obliq) + cos(ecl_lat) * sin(obliq) * sin(ecl_lon))"),
    (
        "hour_angle",
        "radians(280.46061837 + 360.98564736629 * jd_days + 0.000387933 * cent_ut * cent_ut"
        " + nutation_lon * cos(obliq) + longitude) - right_asc",
    ),
    ("lat", "radians(latitude)"),
    ("parallax", "radians(8.794 / (3600.0 * sun_distance))"),
    ("reduced", "atan(0.99664719 * tan(lat))"),
    ("from_axis", "cos(reduced) + altitude / 6378140.0 * cos(lat)"),
    ("from_plane", "0.99664719 * sin(reduced) + altitude / 6378140.0 * sin(lat)"),
    ("across", "cos(declin) - from_axis * sin(parallax) * cos(hour_angle)"),
    ("moved", "atan2(-from_axis * sin(parallax) * sin(hour_angle), across)"),
    ("declin_seen", "atan2((sin(declin) - from_plane * sin(parallax)) * cos(moved), across)"),
    ("hour_seen", "hour_angle - moved"),
    (
        "el_true",
        "degrees(asin(sin(lat) * sin(declin_seen) + cos(lat) * cos(declin_seen) * cos(hour_seen)))",
    ),
    (
        "azimuth_raw",
        "degrees(atan2(sin(hour_seen), cos(hour_seen) * sin(lat) - tan(declin_seen) * cos(lat))) + 180.0",
    ),
    (
        "refraction",
        "CASE WHEN el_true >= -0.83337 THEN (pressure / 1010.0) * (283.0 / (273.0 + temperature))"
        " * 1.02 / (60.0 * tan(radians(el_true + 10.3 / (el_true + 5.11)))) ELSE 0.0 END",
    ),
    ("elevation_raw", "el_true + refraction"),
)


def sun_angles(
    df,
    ts: str = "DateTime",
    latitude: float = SITE_LATITUDE,
    longitude: float = SITE_LONGITUDE,
    utc_offset_hours: float = SITE_UTC_OFFSET_HOURS,
    pressure: float = PRESSURE_HPA,
    temperature: float = TEMPERATURE_C,
    altitude: float = 0.0,
    digits: int | None = 2,
):
    """Add ``Azimuth`` and refraction-corrected ``Elevation`` in degrees for a wall-clock column."""
    keep = df.columns
    place = {
        "utc_offset_h": utc_offset_hours,
        "latitude": latitude,
        "longitude": longitude,
        "pressure": pressure,
        "temperature": temperature,
        "altitude": altitude,
    }
    seconds = epoch_seconds(F.col(ts)).cast("double") + (
        F.extract(F.lit("SECOND"), F.col(ts)) - F.second(F.col(ts))
    ).cast("double")
    out = df.withColumn("sun_epoch_s", seconds).withColumns(
        {name: F.lit(float(value)) for name, value in place.items()}
    )
    for name, text in STEPS:
        out = out.withColumn(name, F.expr(_doubles(text)))
    azimuth: Column = F.col("azimuth_raw")
    elevation: Column = F.col("elevation_raw")
    if digits is not None:
        azimuth, elevation = rint_round(azimuth, digits), rint_round(elevation, digits)
    # Exploding a one-element array keeps a later filter on the angles above this
    # point. Pushed through the steps it would repeat each one wherever it is used.
    angles = F.array(F.struct(azimuth.alias("Azimuth"), elevation.alias("Elevation")))
    return out.select(*keep, F.inline(angles))


def _doubles(text: str) -> str:
    """Mark decimal literals as doubles; SQL would read them as exact decimals."""
    import re

    return re.sub(r"(?<![\w.])(\d+\.\d+)(?![\w.])", r"\1D", text)
