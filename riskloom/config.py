"""Operator parameters as frozen value objects that check themselves on creation."""

from __future__ import annotations

from dataclasses import dataclass, field

# Defaults every default result depends on.
HASH_MULTIPLIER = 2654435761
HASH_MODULUS = 100
TRAIN_MAX = 69
VALID_MAX = 84
SWEEP_RATIOS = (2, 3, 5, 8, 10, 15, 20, 30)
TRACKED_FEATURES = (
    "limit_bal",
    "age",
    "avg_utilization",
    "max_delinquency",
    "months_delinquent",
    "avg_payment_ratio",
    "utilization_trend",
)
NON_MODEL_COLUMNS = ("client_id", "split_name", "default_next_month", "sex")
NOMINAL_COLUMNS = ("education", "marriage")
SPLITS = ("train", "valid", "test")
SEX_LABELS = {1: "male", 2: "female"}
MAX_BATCH = 500


@dataclass(frozen=True)
class SplitRule:
    """Bucket bounds of the deterministic split: 0..train_max train, ..valid_max valid."""

    multiplier: int = HASH_MULTIPLIER
    modulus: int = HASH_MODULUS
    train_max: int = TRAIN_MAX
    valid_max: int = VALID_MAX

    def __post_init__(self) -> None:
        if not 0 <= self.train_max < self.valid_max < self.modulus:
            raise ValueError(
                "split bounds must satisfy 0 <= train_max < valid_max < modulus, got "
                f"{self.train_max}, {self.valid_max}, {self.modulus}"
            )
        # (id % m) * (multiplier % m) stays below m * m; keep that inside a bigint.
        if self.modulus > 2**31:
            raise ValueError("modulus must not exceed 2**31")


@dataclass(frozen=True)
class CostMatrix:
    """Cost of each decision outcome."""

    false_negative: float = 16000.0
    false_positive: float = 3000.0
    true_positive: float = 1500.0
    true_negative: float = 0.0

    def expected_cost(self, tn, fp, fn, tp):
        """Total cost of the four outcome counts; numbers or Spark columns."""
        return (
            tn * self.true_negative
            + fp * self.false_positive
            + fn * self.false_negative
            + tp * self.true_positive
        )

    @property
    def boundary(self) -> float:
        """Probability above which acting is cheaper than waiting."""
        act = self.false_positive - self.true_negative
        return act / (self.false_negative - self.true_positive + act)

    def with_ratio(self, ratio: float) -> CostMatrix:
        """The same matrix with a missed default worth ``ratio`` false alarms."""
        return CostMatrix(
            false_negative=self.false_positive * ratio,
            false_positive=self.false_positive,
            true_positive=self.true_positive,
            true_negative=self.true_negative,
        )


@dataclass(frozen=True)
class Monitoring:
    """Drift thresholds and the features watched."""

    psi_warn: float = 0.10
    psi_alert: float = 0.25
    bins: int = 10
    tracked: tuple[str, ...] = TRACKED_FEATURES

    def __post_init__(self) -> None:
        if not 0 < self.psi_warn < self.psi_alert:
            raise ValueError("need 0 < psi_warn < psi_alert")
        if self.bins < 2:
            raise ValueError("need at least two bins")


@dataclass(frozen=True)
class ModelConfig:
    """Training parameters."""

    target: str = "default_next_month"
    excluded: tuple[str, ...] = NON_MODEL_COLUMNS
    nominal: tuple[str, ...] = NOMINAL_COLUMNS
    seed: int = 42
    search_draws: int = 25
    cv_folds: int = 4
    calibration: str = "isotonic"
    lr_max_iter: int = 2000
    mlp_hidden: tuple[int, ...] = (128, 64)
    mlp_max_iter: int = 100

    def __post_init__(self) -> None:
        if self.calibration not in ("isotonic", "sigmoid"):
            raise ValueError(f"unknown calibration method {self.calibration!r}")
        if self.cv_folds < 2 or self.search_draws < 1:
            raise ValueError("need cv_folds >= 2 and search_draws >= 1")


@dataclass(frozen=True)
class Settings:
    """Everything the plans need, with the published defaults."""

    split: SplitRule = field(default_factory=SplitRule)
    cost: CostMatrix = field(default_factory=CostMatrix)
    monitoring: Monitoring = field(default_factory=Monitoring)
    model: ModelConfig = field(default_factory=ModelConfig)
    max_batch: int = MAX_BATCH
