"""Driver-side policy: thresholds, promotion rules and model families."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

# The shipped policy.
LOW = 0.20
MEDIUM = 0.60
MIN_RECALL = 0.30
FEEDBACK_TRIGGER = 2
TRIALS = 20
VALIDATION_SHARE = 0.3
SPLIT_SEED = 42
LOGISTIC_MAX_ITER = 1000
FOREST_TREES = 200
FOREST_DEPTH = 5
FOREST_SEED = 42


@dataclass(frozen=True)
class Family:
    """One model family in registry order."""

    name: str
    enabled: bool = True
    params: Mapping[str, Any] = field(default_factory=dict)


def _shipped_families() -> tuple[Family, ...]:
    return (
        Family("logistic", True, {"max_iter": LOGISTIC_MAX_ITER}),
        Family("forest", True, {"n_estimators": FOREST_TREES, "max_depth": FOREST_DEPTH,
                                "random_state": FOREST_SEED}),
    )


@dataclass(frozen=True)
class Policy:
    low: float = LOW
    medium: float = MEDIUM
    min_recall: float = MIN_RECALL
    feedback_trigger: int = FEEDBACK_TRIGGER
    retrain_if_no_champion: bool = True
    promote_only_if_better: bool = False
    trials: int = TRIALS
    validation_share: float = VALIDATION_SHARE
    split_seed: int = SPLIT_SEED
    families: tuple[Family, ...] = field(default_factory=_shipped_families)

    @classmethod
    def from_file(cls, path: str) -> "Policy":
        """Read a JSON config, or a YAML one where a YAML parser is installed."""
        with open(path, encoding="utf-8") as f:
            text = f.read()
        if path.endswith((".yaml", ".yml")):
            try:
                import yaml
            except ImportError as e:
                raise RuntimeError("reading YAML needs a YAML parser; use JSON instead") from e
            return cls.from_mapping(yaml.safe_load(text))
        return cls.from_mapping(json.loads(text))

    @classmethod
    def from_mapping(cls, tree: Mapping[str, Any]) -> "Policy":
        """Build from a parsed config tree (models / risk_thresholds / mlops).

        A tree that names no minimum recall gets 0: nothing is blocked.
        """
        bands = tree.get("risk_thresholds", {})
        rules = tree.get("mlops", {})
        families = tuple(
            Family(name, bool(params.get("enabled", True)),
                   {k: v for k, v in params.items() if k != "enabled"})
            for name, params in tree.get("models", {}).items()
        )
        return cls(
            low=float(bands.get("low", LOW)),
            medium=float(bands.get("medium", MEDIUM)),
            min_recall=float(rules.get("min_recall_risky", 0.0)),
            feedback_trigger=int(rules.get("feedback_trigger_size", FEEDBACK_TRIGGER)),
            retrain_if_no_champion=bool(rules.get("retrain_if_no_champion", True)),
            promote_only_if_better=bool(rules.get("promote_only_if_better", False)),
            families=families or _shipped_families(),
        )
