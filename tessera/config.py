"""Settings of a deployment, from a mapping such as the environment; all problems are reported at once."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields
from pathlib import Path

SECRETS = ("password", "secret", "token", "key")


class ConfigError(ValueError):
    """Every problem of the settings."""

    def __init__(self, problems: list[str]):
        self.problems = problems
        super().__init__("; ".join(problems))


@dataclass(frozen=True)
class Config:
    data_root: str
    staging_root: str
    control_db: str
    shuffle_partitions: int = 12
    lease_seconds: int = 3600
    watermark_minutes: int = 10
    window_minutes: int = 5
    kafka_servers: str = ""
    kafka_password: str = ""

    @staticmethod
    def load(given: Mapping[str, str], prefix: str = "TESSERA_") -> Config:
        problems, values = [], {}
        for f in fields(Config):
            raw = given.get(prefix + f.name.upper())
            if raw is None or raw == "":
                if f.name in ("data_root", "staging_root", "control_db"):
                    problems.append(f"{prefix}{f.name.upper()} is missing")
                continue
            if f.type == "int":
                if not raw.strip().isdigit() or int(raw) < 1:
                    problems.append(f"{prefix}{f.name.upper()} isn't a positive whole number: {raw!r}")
                    continue
                values[f.name] = int(raw)
            else:
                values[f.name] = raw
        if "data_root" in values and "staging_root" in values:
            a, b = Path(os.path.abspath(values["data_root"])), Path(os.path.abspath(values["staging_root"]))
            if a == b or a in b.parents or b in a.parents:
                problems.append("data and staging roots lie in each other")
        if problems:
            raise ConfigError(problems)
        return Config(**values)

    def redacted(self) -> dict[str, object]:
        """The settings for a log, without secrets."""
        hidden = lambda n: any(s in n for s in SECRETS) and getattr(self, n)
        return {f.name: "***" if hidden(f.name) else getattr(self, f.name) for f in fields(self)}
