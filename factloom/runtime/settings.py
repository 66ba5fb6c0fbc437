"""Settings: what the caller gives, else the environment, else a default; what has none fails by name."""

from __future__ import annotations

import hashlib
import os
from dataclasses import dataclass
from datetime import date

PREFIX = "FACTLOOM_"
INGEST_MODES, STORAGE_MODES, GOLD_MODES = ("stream", "batch"), ("local", "shared"), ("rebuild", "changes")


class MissingSetting(Exception):
    def __init__(self, key: str):
        self.key = key
        super().__init__(f"setting {key} is not given; pass {key}=... or set {PREFIX}{key.upper()}")


@dataclass(frozen=True)
class Settings:
    logical_date: str
    landing_root: str
    warehouse: str
    export_root: str
    checkpoint_root: str
    environment: str = "dev"
    ingest_mode: str = "stream"
    storage_mode: str = "local"
    gold_mode: str = "rebuild"

    @property
    def run_id(self) -> str:
        return run_id_for("run", self.logical_date)


def run_id_for(task: str, logical_date: str, *inputs: str) -> str:
    """The same for the same task, day and inputs, whatever their order and the clock."""
    return f"{task}-{logical_date}-{hashlib.sha256('|'.join([task, logical_date, *sorted(inputs)]).encode()).hexdigest()[:12]}"


def batch_id_for(stream: str, logical_date: str) -> str:
    return f"{stream}-{logical_date}"


def resolve(**given: str | None) -> Settings:
    def value(key: str, default: str | None = None) -> str:
        got = given.get(key) or os.environ.get(PREFIX + key.upper()) or default
        if not got:
            raise MissingSetting(key)
        return got

    def one_of(key: str, allowed: tuple[str, ...]) -> str:
        if (got := value(key, allowed[0])) not in allowed:
            raise ValueError(f"{key} is {got}, not one of {', '.join(allowed)}")
        return got

    day = value("logical_date")
    if date.fromisoformat(day).isoformat() != day:
        raise ValueError(f"logical_date {day} is not of the form YYYY-MM-DD")
    root = value("landing_root")
    s = Settings(day, root, value("warehouse"), value("export_root"), value("checkpoint_root", f"{root.rstrip('/')}/_checkpoints"), value("environment", "dev"), one_of("ingest_mode", INGEST_MODES), one_of("storage_mode", STORAGE_MODES), one_of("gold_mode", GOLD_MODES))
    if s.storage_mode == "shared" and (local := [p for p in (s.landing_root, s.warehouse, s.export_root, s.checkpoint_root) if "://" not in p or p.startswith("file:")]):
        raise ValueError(f"storage_mode is shared, but {', '.join(local)} lie on one machine alone")
    return s
