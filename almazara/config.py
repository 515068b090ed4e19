"""Run configurations: frozen, read from JSON, unknown keys refused."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields
from pathlib import Path


@dataclass(frozen=True)
class RunConfig:
    """One run of the command line; relative paths are below the configuration's folder."""

    kind: str
    inputs: tuple[str, ...]
    output: str
    artifacts: str = "artifacts"
    rows_per_file: int = 1_000_000
    max_rows: int | None = None
    lenient: bool = False
    options: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        if not self.kind or not self.inputs:
            raise ValueError("kind and inputs are required")
        if self.rows_per_file < 1 or (self.max_rows is not None and self.max_rows < 1):
            raise ValueError("rows_per_file and max_rows must be positive")

    @classmethod
    def load(cls, path: str | Path) -> RunConfig:
        """Configuration of a JSON file; a key that is not known is an error."""
        file = Path(path).resolve()
        values = json.loads(file.read_text(encoding="utf-8"))
        unknown = sorted(set(values) - {f.name for f in fields(cls)})
        if unknown:
            raise ValueError("unknown configuration keys: " + ", ".join(unknown))
        here = lambda p: p if "://" in p or Path(p).is_absolute() else str((file.parent / p).resolve())
        values["inputs"] = tuple(here(p) for p in values.get("inputs", ()))
        for key in ("output", "artifacts"):
            if key in values:
                values[key] = here(values[key])
        return cls(**values)
