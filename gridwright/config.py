"""Thresholds, dataset facts and per-domain column roles."""

from __future__ import annotations

from dataclasses import dataclass

OK, SUSPECT, BAD = 0, 1, 2
DEFAULT_HORIZONS = (1, 6, 12, 24, 48)


@dataclass(frozen=True)
class WindLimits:
    """Limits for 10-minute turbine data."""

    max_wind_ms: float = 40.0
    power_tolerance: float = 1.05
    frozen_minutes: int = 60
    fill_minutes: int = 30
    min_curtailed_pitch_deg: float = 3.0
    min_curtailed_wind_ms: float = 8.0
    curtailed_power_share: float = 0.5
    step_minutes: int = 10

    @property
    def frozen_repeats(self) -> int:
        return self.frozen_minutes // self.step_minutes

    @property
    def fill_rows(self) -> int:
        return self.fill_minutes // self.step_minutes


@dataclass(frozen=True)
class DemandLimits:
    """Limits for hourly grid load."""

    min_load_mw: float = 10_000.0
    max_load_mw: float = 100_000.0
    min_temperature_c: float = -20.0
    max_temperature_c: float = 50.0
    max_wind_ms: float = 50.0
    fill_rows: int = 3


@dataclass(frozen=True)
class SolarLimits:
    """Limits for 15-minute photovoltaic output."""

    max_power_kw: float = 5.0
    min_irradiance_wm2: float = -10.0
    max_irradiance_wm2: float = 1500.0
    min_temperature_c: float = -30.0
    max_temperature_c: float = 60.0
    night_power_kw: float = 0.01
    bright_irradiance_wm2: float = 200.0
    fill_rows: int = 4


@dataclass(frozen=True)
class Domain:
    """Which columns carry the series id and the target, and the feature spans."""

    name: str
    series: str
    target: str
    step_minutes: int
    lags: tuple[int, ...]
    windows: tuple[int, ...]
    std_up_to: int

    @property
    def lag1(self) -> str:
        return f"{self.target}_lag1"


# Lags, rolling windows and step per domain.
DOMAINS = {
    "wind": Domain("wind", "turbine_id", "active_power_kw", 10, (1, 2, 3, 6, 12, 24), (6, 12, 24), 24),
    "demand": Domain("demand", "zone_id", "load_mw", 60, (1, 2, 24, 168), (24, 168), 24),
    "solar": Domain("solar", "system_id", "power_kw", 15, (1, 2, 4, 8, 96), (4, 16, 96), 4),
}


@dataclass(frozen=True)
class Dataset:
    """Facts about one public dataset."""

    dataset_id: str
    domain: str
    latitude: float
    longitude: float
    train_years: int = 5
    val_years: int = 1
    timezone: str = "UTC"
    rated_power_kw: float | None = None
    zone_id: str | None = None
    system_id: str | None = None
    n_turbines: int | None = None
    hub_height_m: float | None = None
    rotor_diameter_m: float | None = None
    population: int | None = None
    capacity_kw: float | None = None
    tilt_deg: float | None = None
    azimuth_deg: float | None = None


# Published site facts.
DATASETS = {
    d.dataset_id: d
    for d in (
        Dataset("kelmarsh", "wind", 52.4016, -0.9436, rated_power_kw=2050.0, n_turbines=6,
                hub_height_m=78.5, rotor_diameter_m=92.0),
        Dataset("hill_of_towie", "wind", 57.34, -2.65, rated_power_kw=2300.0, n_turbines=21,
                hub_height_m=80.0, rotor_diameter_m=82.0),
        Dataset("penmanshiel", "wind", 55.905, -2.29, rated_power_kw=2050.0, n_turbines=13,
                hub_height_m=78.5, rotor_diameter_m=82.0),
        Dataset("spain_demand", "demand", 40.4168, -3.7038, train_years=2, timezone="Europe/Madrid",
                zone_id="ES", population=47_000_000),
        Dataset("rte_france", "demand", 48.8566, 2.3522, train_years=8, val_years=2,
                timezone="Europe/Paris", zone_id="FR", population=68_000_000),
        Dataset("pvdaq_system4", "solar", 39.7407, -105.1686, timezone="America/Denver", system_id="4",
                capacity_kw=2.2, tilt_deg=40.0, azimuth_deg=180.0),
    )
}
