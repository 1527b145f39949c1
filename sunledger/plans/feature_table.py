"""The whole feature build as one lazy plan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from sunledger.operators.joins import lookup_default, unmapped_keys
from sunledger.operators.quality import start_cutoff
from sunledger.plans.insolation import add_insolation
from sunledger.plans.irradiance import add_irradiance
from sunledger.plans.sun import add_sun_angles
from sunledger.plans.weather import add_weather
from sunledger.session import materialise

# Sites whose first hours have no weather data.
VALID_FROM = {1: "2024-01-01 08:00:00", 17: "2024-01-01 08:00:00"}


@dataclass
class SharedSeries:
    """Series that all sites share, and the site attributes."""

    weather: DataFrame
    sun: DataFrame
    insolation_minutes: DataFrame
    irradiance_minutes: DataFrame
    sites: DataFrame

    def stored(self) -> SharedSeries:
        """Each series written once: they are as long as the calendar or the weather
        feed, not as the site data, and every feature build joins them."""
        return SharedSeries(
            materialise(self.weather, "weather"),
            materialise(self.sun, "sun"),
            materialise(self.insolation_minutes, "insolation"),
            materialise(self.irradiance_minutes, "irradiance"),
            self.sites,
        )


def add_site_attributes(df: DataFrame, sites: DataFrame) -> DataFrame:
    return lookup_default(df, sites, ["angle", "story"])


def unmapped_sites(df: DataFrame, sites: DataFrame) -> DataFrame:
    return unmapped_keys(df, sites)


def build_features(
    rows: DataFrame,
    shared: SharedSeries,
    order: Sequence[str] = ("DateTime",),
    weather_sequence: str | None = None,
    series: Sequence[str] = ("LocationCode",),
    valid_from: Mapping[int, str] | None = None,
    one_per_minute: bool = False,
    stored: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) feature rows for training or serving rows.

    Cleaned training rows are ``one_per_minute`` per site. ``stored`` writes the
    judged rows once, for callers that use both results.
    """
    with_weather = add_weather(
        rows, shared.weather, order, series=series, sequence=weather_sequence, one_per_minute=one_per_minute
    )
    started = start_cutoff(with_weather, valid_from or {})
    with_sun = add_sun_angles(started, shared.sun)
    accepted, rejected = add_insolation(with_sun, shared.insolation_minutes, stored)
    with_sites = add_site_attributes(accepted, shared.sites)
    return add_irradiance(with_sites, shared.irradiance_minutes), rejected
