"""Settings of a statement run, with their defaults."""

from __future__ import annotations

import json
from dataclasses import dataclass, fields
from pathlib import Path


@dataclass(frozen=True)
class Config:
    """Paths are anything that Spark reads and writes. A folder of tables may be given instead of pages."""

    output: str
    pages: str | None = None
    tables: str | None = None
    table_prefix: str = "table_"
    dpi: int = 350
    max_image_dimension: int = 2048
    batch_size: int = 7
    tolerance: float = 0.01
    max_correction_iterations: int = 3
    table_name: str = "brokerage_statement"
    answers: str | None = None
    attempts: int = 3
    retry_delay: float = 5.0
    reassign_by_name: bool = False

    @property
    def answers_path(self) -> str:
        """Where a model's answers are written down; a folder that all executors share."""
        return self.answers or f"{self.output}/answers"

    @classmethod
    def of(cls, settings: dict) -> Config:
        """From a mapping; sections are flattened, settings of other tools ignored."""
        flat = {}
        for key, value in settings.items():
            flat.update(value if isinstance(value, dict) else {key: value})
        names = {f.name for f in fields(cls)}
        return cls(**{k: v for k, v in flat.items() if k in names})

    @classmethod
    def load(cls, path: str) -> Config:
        """From a JSON file, or a YAML file where that library is installed."""
        text = Path(path).read_text()
        if path.endswith(".json"):
            return cls.of(json.loads(text))
        import yaml

        return cls.of(yaml.safe_load(text))
