"""Settings of a run from a JSON or YAML file."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field, fields


@dataclass(frozen=True)
class Settings:
    """What a run of the engine can be told. Dates are texts, yyyy-mm-dd."""

    video_sources: list = field(default_factory=list)
    stations: list = field(default_factory=list)
    ignored_stations: list = field(default_factory=list)
    years: list = field(default_factory=list)
    first_date: str | None = None
    last_date: str | None = None
    confidence: float = 0.25
    edge_margin: float = 50.0
    clip_before: float = 5.0
    clip_after: float = 5.0
    max_retries: int = 3

    def __post_init__(self):
        wrong = []
        for name in ("video_sources", "stations", "ignored_stations", "years"):
            if not isinstance(getattr(self, name), list):
                wrong.append(f"{name} is no list")
        for name, low, high in (("confidence", 0, 1), ("edge_margin", 0, None), ("clip_before", 0, None), ("clip_after", 0, None), ("max_retries", 0, None)):
            value = getattr(self, name)
            if isinstance(value, bool) or not isinstance(value, (int, float)) or value < low or (high is not None and value > high):
                wrong.append(f"{name} is no number from {low}" + (f" to {high}" if high is not None else ""))
        if self.first_date and self.last_date and str(self.first_date) > str(self.last_date):
            wrong.append("first_date is after last_date")
        if wrong:
            raise ValueError("; ".join(wrong))


def expanded(value):
    """A nested value with $NAME and ${NAME} in its texts replaced from the environment."""
    if isinstance(value, str):
        return os.path.expandvars(value)
    if isinstance(value, list):
        return [expanded(v) for v in value]
    return {k: expanded(v) for k, v in value.items()} if isinstance(value, dict) else value


def load(path: str) -> Settings:
    """Settings from a file; unknown names and wrong values raise ValueError. YAML
    needs the yaml library; JSON, which is YAML too, does not."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    try:
        raw = json.loads(text) if text.strip() else {}
    except ValueError:
        import yaml

        raw = yaml.safe_load(text) or {}
    if not isinstance(raw, dict):
        raise ValueError("settings are no mapping")
    unknown = set(raw) - {f.name for f in fields(Settings)}
    if unknown:
        raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
    return Settings(**expanded(raw))
