"""Settings. Defaults are the values the pipeline is specified with; tests and adapters scale them."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class WindowSpec:
    """Event-time windows in seconds. ``rate_unit_s`` is the unit rates are expressed per."""

    short_s: int = 60
    long_s: int = 300
    rate_unit_s: int = 60
    watermark_s: int = 5
    # Width of the time chunks a key's history is split into (see operators/chunks.py).
    chunk_s: int = 7 * 86400

    @property
    def short(self) -> str:
        return f"{self.short_s} seconds"

    @property
    def long(self) -> str:
        return f"{self.long_s} seconds"

    @property
    def panes(self) -> int:
        return self.long_s // self.short_s


@dataclass(frozen=True)
class ScoringSpec:
    stockout_ratio: float = 1.0
    surge_momentum: float = 2.5
    offline_surge_momentum: float = 2.0
    default_reorder_point: int = 20


@dataclass(frozen=True)
class DriftSpec:
    features: tuple[str, ...] = ("order_rate", "depletion_vel", "demand_momentum", "on_hand_est")
    current_s: int = 3600
    reference_s: int = 24 * 3600
    bins: int = 10
    psi_threshold: float = 0.25
    min_current: int = 5
    min_reference: int = 10
    min_values: int = 5
    fallback_current_frac: float = 0.2


@dataclass(frozen=True)
class ForestSpec:
    trees: int = 100
    max_samples: int = 256
    contamination: float = 0.05
    seed: int = 42


@dataclass(frozen=True)
class BoostSpec:
    rounds: int = 200
    depth: int = 4
    learning_rate: float = 0.05
    subsample: float = 0.8
    colsample: float = 0.8
    seed: int = 42
    l2: float = 1.0  # penalty on leaf weights
    least_weight: float = 1.0  # hessian on each side of a split
    bins: int = 256  # at most; a bin number is one byte


# Minutes between two promotions of a model, and between two retrains of a job.
PROMOTE_COOLDOWN_MIN = 30
RETRAIN_COOLDOWN_MIN = {"detector_retrain": 60, "forecaster_retrain": 120}
# Share of the newest rows kept for evaluation.
HOLDOUT_FRACTION = 0.2
