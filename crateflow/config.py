"""Settings as frozen values, checked when made; they reach plans as literals."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class Settings:
    """Where the station is and what its services ask for; from the environment by upper-case names."""

    station_url: str
    station_key: str
    station_id: int = 1
    tag_key: str | None = None
    release_token: str | None = None
    notify_key: str | None = None

    def __post_init__(self):
        if not self.station_url.startswith(("http://", "https://")):
            raise ValueError("station_url must be a link")
        object.__setattr__(self, "station_url", self.station_url.rstrip("/"))
        if len(self.station_key.strip()) < 8:
            raise ValueError("station_key is too short")
        if int(self.station_id) < 1:
            raise ValueError("station_id must be positive")
        object.__setattr__(self, "station_id", int(self.station_id))

    @classmethod
    def read(cls, env: Mapping[str, str] | None = None) -> Settings:
        env = os.environ if env is None else env
        return cls(**{f.name: env[f.name.upper()] for f in fields(cls) if env.get(f.name.upper())})

    def missing(self) -> list[str]:
        """Optional services that have no key."""
        return [f.name for f in fields(self) if f.default is None and getattr(self, f.name) is None]


@dataclass(frozen=True)
class Gates:
    """Limits of the audio and taste filters."""

    shortest: float = 120.0
    longest: float = 330.0
    slowest: int = 60
    fastest: int = 170
    voice: float = 0.7
    require_tags: bool = False
    cooldown_days: float = 90.0
    taste: float = 0.62
    log_only: bool = False

    def __post_init__(self):
        if not self.shortest < self.longest or not self.slowest < self.fastest:
            raise ValueError("a lower limit is not below its upper one")
