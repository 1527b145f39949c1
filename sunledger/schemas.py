"""Explicit schemas of the domain inputs. All stored timestamps are wall clock (NTZ)."""

from __future__ import annotations

SITE_POWER = (
    "LocationCode int, DateTime timestamp_ntz, `WindSpeed(m/s)` double, `Pressure(hpa)` double, "
    "`Temperature(°C)` double, `Humidity(%)` double, `Sunlight(Lux)` double, `Power(mW)` double"
)
STATION_SENSORS = (
    "WindSpeed(m/s)",
    "Pressure(hpa)",
    "Temperature(°C)",
    "Humidity(%)",
    "Sunlight(Lux)",
)
WEATHER_TEXT = "time timestamp_ntz, H_UVI string, TEMP string"
WEATHER = "time timestamp_ntz, H_UVI double, TEMP double"
WEATHER_PAYLOAD = (
    "records struct<Station: array<struct<StationId: string, ObsTime: struct<DateTime: string>, "
    "WeatherElement: struct<UVIndex: string, AirTemperature: string>>>>"
)
IRRADIANCE_PAYLOAD = (
    "date string, irradiance struct<intervals: array<struct<start: string, "
    "clear_sky: struct<ghi: double, dni: double, dhi: double>>>>"
)
IRRADIANCE = "DateTime timestamp_ntz, GHI double, DNI double, DHI double"
STATION_HOURLY = "DateTime string, Solarinsolation string"
INSOLATION = "DateTime timestamp_ntz, Solarinsolation double"
SUN_POSITION = "DateTime timestamp_ntz, Azimuth double, Elevation double"
QUESTIONS = "`序號` string, `答案` string"
PREDICTIONS = "LocationCode int, DateTime timestamp_ntz, `Predicted_Power(mW)` double"

SERIAL, ANSWER = "序號", "答案"
CORRUPT = "_corrupt_record"
