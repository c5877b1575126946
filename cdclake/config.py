"""Settings with their usual values."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields


@dataclass(frozen=True)
class Settings:
    root: str = "warehouse"
    partition_columns: tuple[str, ...] = ("p_y", "p_m", "p_d")
    file_minutes: int = 5
    file_rows: int = 100_000
    greedy_files: int = 5
    delay_minutes: int = 5
    delay_attempts: int = 3
    delay_hours: int = 1
    compact_files: int = 5
    databases: dict[str, str] = field(default_factory=dict)  # source name: target name

    @classmethod
    def load(cls, text: str) -> Settings:
        """From JSON; unknown names are errors."""
        given = json.loads(text)
        if unknown := set(given) - {f.name for f in fields(cls)}:
            raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
        return cls(**{k: tuple(v) if isinstance(v, list) else v for k, v in given.items()})
