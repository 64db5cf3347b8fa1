"""Business thresholds in one immutable record."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    # Thresholds of the published business rules.
    abc_a_pct: float = 80.0
    abc_b_pct: float = 95.0
    xyz_x_cov: float = 0.50
    xyz_y_cov: float = 1.00
    no_demand_cov: float = 9999.0
    service_z: float = 1.645
    service_z_high: float = 2.054
    dead_days: int = 365
    slow_days: int = 180
    watch_days: int = 90
    horizon_months: int = 6
    holdout_months: int = 3
    min_history_months: int = 12
    season_months: int = 12
    ordering_cost: float = 25.0
    holding_rate: float = 0.25
    default_lead_time: float = 21.0
    default_lead_time_std: float = 7.0
    single_po_lead_time_std: float = 3.0
    default_unit_cost: float = 50.0
    default_on_time_rate: float = 0.80
    iqr_multiplier: float = 3.0
    mape_retry_pct: float = 30.0
    label_days: int = 14


DEFAULTS = Settings()
