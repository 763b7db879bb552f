"""Scoring policy: knobs as literals, lookups as constant maps (no join needed)."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# The policy tables. Weights are by field, then by source class.
RISK = {
    "phone": "low",
    "website": "low",
    "suite": "low",
    "address": "medium",
    "specialty": "medium",
    "practice_name": "medium",
    "affiliation": "medium",
    "provider_name": "high",
    "npi": "high",
    "active": "high",
}
WEIGHTS = {
    "provider_name": {"gov_self_reported": 0.95, "gov_claims": 0.80, "practice_web": 0.50, "regulatory_board": 0.85},
    "npi": {"gov_self_reported": 0.99, "gov_claims": 0.85},
    "specialty": {"gov_self_reported": 0.92, "gov_claims": 0.82, "practice_web": 0.40, "regulatory_board": 0.70},
    "practice_name": {"gov_self_reported": 0.88, "gov_claims": 0.80, "practice_web": 0.55},
    "address": {"gov_self_reported": 0.66, "gov_claims": 0.62, "practice_web": 0.68, "regulatory_board": 0.50},
    "phone": {"gov_self_reported": 0.66, "gov_claims": 0.62, "practice_web": 0.66, "regulatory_board": 0.40},
    "website": {"gov_self_reported": 0.40, "practice_web": 0.80},
    "active": {"gov_self_reported": 0.95, "gov_claims": 0.85, "practice_web": 0.30, "regulatory_board": 0.90},
}
DEFAULT_WEIGHT, DEFAULT_RISK = 0.40, "medium"
RISK_LEVELS = {"low": 0, "medium": 1, "high": 2}


@dataclass(frozen=True)
class Policy:
    """All knobs; ``as_of`` has no default, so no result depends on a clock."""

    as_of: date
    thresholds: dict = field(default_factory=lambda: {"low": 0.85, "medium": 0.90, "high": 0.95})
    min_classes: dict = field(default_factory=lambda: {"low": 1, "medium": 2, "high": 2})
    never_auto: tuple = ("provider_name", "npi", "active")
    tau_low: float = 0.50
    conflict_share: float = 0.25
    rho: float = 0.5
    halflife_days: float = 540.0
    freshness_floor: float = 0.3
    weights: dict = field(default_factory=lambda: WEIGHTS)
    risk: dict = field(default_factory=lambda: RISK)

    def risk_of(self, name: Column) -> Column:
        return lookup(self.risk, name, DEFAULT_RISK)

    def weight_of(self, name: Column, source_class: Column) -> Column:
        flat = {f"{f}|{c}": w for f, row in self.weights.items() for c, w in row.items()}
        return lookup(flat, F.concat_ws("|", name, source_class), DEFAULT_WEIGHT)

    def freshness_of(self, day: Column) -> Column:
        age = F.greatest(F.date_diff(F.lit(self.as_of), day), F.lit(0))
        decay = F.greatest(F.pow(F.lit(0.5), age / self.halflife_days), F.lit(self.freshness_floor))
        return F.when(day.isNull(), F.lit(1.0)).otherwise(decay)


def lookup(table: dict, key: Column, default=None) -> Column:
    """A constant table as an expression: stays inside code generation, needs no join."""
    pairs = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    found = F.try_element_at(pairs, key)
    return found if default is None else F.coalesce(found, F.lit(default))
