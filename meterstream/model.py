"""The model set: scaler statistics, K-means centres and the anomaly threshold."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from . import constants as C


@dataclass(frozen=True)
class MeterModel:
    features: tuple[str, ...]
    mean: tuple[float, ...]
    std: tuple[float, ...]
    centres: tuple[tuple[float, ...], ...]
    threshold: float
    threshold_rule: str = "mean+3sd"
    extra: dict = field(default_factory=dict, compare=False)

    @property
    def k(self) -> int:
        return len(self.centres)

    def validate(self) -> "MeterModel":
        d = len(self.features)
        if self.threshold is None:
            raise ValueError("model has no threshold")
        if len(self.mean) != d or len(self.std) != d:
            raise ValueError("scaler size does not match the features")
        if not self.centres or any(len(c) != d for c in self.centres):
            raise ValueError("centres do not match the features")
        return self

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_dict(d: dict) -> "MeterModel":
        return MeterModel(
            features=tuple(d["features"]), mean=tuple(map(float, d["mean"])),
            std=tuple(map(float, d["std"])),
            centres=tuple(tuple(map(float, c)) for c in d["centres"]),
            threshold=None if d.get("threshold") is None else float(d["threshold"]),
            threshold_rule=d.get("threshold_rule", "mean+3sd"),
            extra=d.get("extra", {}) or {}).validate()


# Frozen model for repeatable comparisons: rounded from a K-means fit (k = 3,
# seed 42) of the driver's sf0.01 readings (water = 4 * props.k).
FROZEN = MeterModel(
    features=C.FEATURES,
    mean=(49.63, 199.29),
    std=(49.10, 116.09),
    centres=((-0.3156, 0.8503), (1.9598, 0.0085), (-0.3155, -0.9109)),
    threshold=1.9327,
)

# A second frozen model, with two centres and a lower threshold, for comparisons in which the model changes.
STRICT = MeterModel(
    features=C.FEATURES,
    mean=(49.63, 199.29),
    std=(49.10, 116.09),
    centres=((-0.25, 0.0), (2.1, 0.05)),
    threshold=1.6,
)
