"""Settings shared by the operators; every literal a query depends on is here."""

from __future__ import annotations

from dataclasses import dataclass

# Sensor, component and strategy names of the data model.
SENSORS = ("volt", "rotate", "pressure", "vibration")
FEATURE_SENSORS = ("voltage", "rotation_speed", "pressure", "vibration")
COMPONENTS = ("comp1", "comp2", "comp3", "comp4")
OTHER = "other"

# Feature windows (hours), lags (rows) and label horizons (hours).
ROLLING_HOURS = (6, 12, 24, 48, 72, 168)
LAG_ROWS = (1, 3, 6, 12, 24, 48, 72, 168)
TREND_ROWS = (24, 72, 168)
SPECTRAL_ROWS = 64
SEQUENCE_ROWS = 48
NO_FAILURE_HOURS = 9999.0


@dataclass(frozen=True)
class Costs:
    """Dollar and hour constants of the cost model (fixed values)."""

    planned: float = 2500.0
    emergency: float = 15000.0
    downtime_hour: float = 8000.0
    planned_hours: float = 4.0
    emergency_hours: float = 12.0
    inspection: float = 500.0
    hardware_per_machine: float = 20000.0
    platform_per_year: float = 50000.0
    personnel_per_year: float = 120000.0

    @property
    def planned_event(self) -> float:
        return self.planned + self.planned_hours * self.downtime_hour

    @property
    def emergency_event(self) -> float:
        return self.emergency + self.emergency_hours * self.downtime_hour


@dataclass(frozen=True)
class CostMatrix:
    """Cost of each prediction outcome (fixed values)."""

    tp: float = 500.0
    fp: float = 500.0
    fn: float = 12000.0
    tn: float = 0.0


@dataclass(frozen=True)
class Params:
    """Periods and limits. ``as_of`` None means the newest telemetry reading."""

    as_of: str | None = None
    baseline: tuple[str, str] = ("2015-01-01", "2015-01-31")  # both ends included
    threshold_period: tuple[str, str] = ("2015-01-01", "2015-06-30")  # both included
    reference_before: str = "2015-06-01"
    recent_from: str = "2015-11-01"
    overdue_days: int = 90
    observation_start: str = "2015-01-01"
    horizon_hours: float = 8760.0
    survival_hours: tuple[int, ...] = (2000, 4000, 6000, 8000)
    months_observed: float = 12.0
    slope_min_points: int = 100
    effect_days: int = 30
    detection_rate: float = 0.8
    fleet_size: int | None = None  # None: machines that report telemetry
    costs: Costs = Costs()


# The same settings for the January 2024 test tables.
FIXTURE = Params(
    baseline=("2024-01-01", "2024-01-08"),
    threshold_period=("2024-01-01", "2024-01-15"),
    reference_before="2024-01-15",
    recent_from="2024-01-23",
    overdue_days=7,
    observation_start="2024-01-01",
    horizon_hours=720.0,
    survival_hours=(168, 336, 504, 672),
    months_observed=1.0,
    slope_min_points=30,
    effect_days=7,
)
