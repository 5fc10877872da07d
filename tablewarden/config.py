"""Settings from a YAML file: dot-path look-ups, a TableSpec and Thresholds."""

from __future__ import annotations

from pathlib import Path

from tablewarden.spec import PATIENT, TableSpec, Thresholds


class Settings(dict):
    """Nested settings with ``get("a.b.c", default)``; a missing file raises."""

    @classmethod
    def from_yaml(cls, path: str) -> Settings:
        import yaml

        return cls(yaml.safe_load(Path(path).read_text()) or {})

    def get(self, path, default=None):
        node = dict(self)
        for key in path.split("."):
            if not isinstance(node, dict) or key not in node:
                return default
            node = node[key]
        return node

    def table_spec(self, base: TableSpec = PATIENT) -> TableSpec:
        return base.with_(
            numerical=tuple(self.get("features.numerical", base.numerical)),
            categorical=tuple(self.get("features.categorical", base.categorical)),
            target=self.get("features.target", base.target),
            drop=tuple(self.get("features.drop_columns", base.drop)),
        )

    def thresholds(self) -> Thresholds:
        d = Thresholds()
        return Thresholds(
            drift_p_value=self.get("monitoring.drift_threshold", d.drift_p_value),
            degradation=self.get("monitoring.performance_degradation_threshold", d.degradation),
            min_samples_for_retrain=self.get(
                "continuous_training.min_samples_for_retrain", d.min_samples_for_retrain
            ),
        )
