"""Thresholds, channels and other knobs as one typed, immutable object.

All percentages are on the 0-100 scale.
"""

from __future__ import annotations

from dataclasses import dataclass, field, fields, is_dataclass, replace
from typing import Any, Mapping


@dataclass(frozen=True)
class CostThresholds:
    daily_increase_percent: float = 20.0
    absolute_cost: float = 1000.0
    above_average_percent: float = 20.0
    anomaly_alert_percent: float = 50.0
    anomaly_warning_percent: float = 25.0


@dataclass(frozen=True)
class JobThresholds:
    failure_rate_percent: float = 10.0
    consecutive_failures: int = 3
    duration_increase_percent: float = 50.0
    baseline_runs: int = 10
    max_duration_minutes: int = 120


@dataclass(frozen=True)
class QualityThresholds:
    score: float = 95.0
    critical_score: float = 90.0
    failed_records: int = 1000
    pass_rate: float = 90.0
    healthy: float = 95.0
    warning: float = 90.0
    critical: float = 80.0


@dataclass(frozen=True)
class FreshnessThresholds:
    listed_hours: int = 12
    warning_hours: int = 24
    critical_hours: int = 48


@dataclass(frozen=True)
class QueryThresholds:
    listed_ms: int = 10_000
    slow_seconds: int = 60
    error_rate_percent: float = 5.0


@dataclass(frozen=True)
class Channel:
    name: str
    enabled: bool


@dataclass(frozen=True)
class Delivery:
    """Which channels get critical alerts, and how often."""

    channels: tuple[Channel, ...] = (
        Channel("email", True),
        Channel("slack", False),
        Channel("teams", False),
        Channel("pagerduty", False),
    )
    max_per_hour: int = 10
    cooldown_minutes: int = 60


@dataclass(frozen=True)
class Rates:
    """Price model used to estimate usage and cost of runs and clusters."""

    dbu_per_hour: str = "2.0"
    cost_per_dbu: str = "0.15"


@dataclass(frozen=True)
class Retention:
    history_days: int = 90
    audit_days: int = 365


@dataclass(frozen=True)
class Settings:
    catalog: str = "main"
    schema: str = "monitoring"
    lookback_days: int = 7
    lineage_lookback_days: int = 30
    drift_threshold: float = 0.1
    batch_files: int = 16
    pii_columns: tuple[str, ...] = ("email", "phone_number", "ssn")
    dry_run: bool = False
    cost: CostThresholds = field(default_factory=CostThresholds)
    jobs: JobThresholds = field(default_factory=JobThresholds)
    quality: QualityThresholds = field(default_factory=QualityThresholds)
    freshness: FreshnessThresholds = field(default_factory=FreshnessThresholds)
    queries: QueryThresholds = field(default_factory=QueryThresholds)
    delivery: Delivery = field(default_factory=Delivery)
    rates: Rates = field(default_factory=Rates)
    retention: Retention = field(default_factory=Retention)

    def table(self, name: str) -> str:
        """Three-part name of one of the engine's own tables."""
        return f"{self.catalog}.{self.schema}.{name}"

    def overlay(self, changes: Mapping[str, Any]) -> "Settings":
        """A copy with nested overrides, e.g. ``{"cost": {"absolute_cost": 5}}``."""
        return _overlay(self, changes)


def _overlay(node: Any, changes: Mapping[str, Any]) -> Any:
    known = {f.name for f in fields(node)}
    unknown = set(changes) - known
    if unknown:
        raise ValueError(f"unknown settings: {sorted(unknown)}")
    resolved = {
        name: _overlay(getattr(node, name), value)
        if is_dataclass(getattr(node, name)) and isinstance(value, Mapping)
        else value
        for name, value in changes.items()
    }
    return replace(node, **resolved)


DEFAULTS = Settings()
