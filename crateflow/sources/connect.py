"""What a connector needs around its requests: pauses, retries, a breaker and a bounded memo. Time is passed in, so all is testable."""

from __future__ import annotations

import random
from collections import OrderedDict
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any


@dataclass(frozen=True)
class Retry:
    """Delays before tries: base * 2^n, at most ``most``, give or take a tenth."""

    base: float = 1.0
    most: float = 60.0
    jitter: float = 0.1

    def delay(self, attempt: int, rnd: Callable[[], float] = random.random) -> float:
        plain = min(self.base * 2**attempt, self.most)
        return plain * (1 + self.jitter * (2 * rnd() - 1))


@dataclass
class Breaker:
    """Closed until so many failures in a row; then open for a time, then half open: one success closes, one failure opens it."""

    failures: int = 5
    rest: float = 60.0
    count: int = 0
    opened: float | None = None

    def state(self, now: float) -> str:
        if self.opened is None:
            return "closed"
        return "half_open" if now - self.opened >= self.rest else "open"

    def success(self) -> None:
        self.count, self.opened = 0, None

    def failure(self, now: float) -> None:
        half = self.state(now) == "half_open"
        self.count += 1
        if half or self.count >= self.failures:
            self.opened = now


@dataclass
class Throttle:
    """Seconds to wait so that requests are ``interval`` apart."""

    interval: float = 1.05
    last: float | None = None

    def wait(self, now: float) -> float:
        pause = 0.0 if self.last is None else max(0.0, self.last + self.interval - now)
        self.last = now + pause
        return pause


@dataclass
class Memo:
    """Results by key; when full the older half goes."""

    most: int = 1000
    held: OrderedDict = field(default_factory=OrderedDict)

    def get(self, key) -> Any:
        return self.held.get(key)

    def put(self, key, value) -> None:
        if key not in self.held and len(self.held) >= self.most:
            for k in list(self.held)[: self.most // 2]:
                del self.held[k]
        self.held[key] = value


def progress(done: int, total: int, seconds: float) -> tuple[float, float]:
    """(rate a second, seconds left)."""
    rate = done / seconds if seconds > 0 else 0.0
    return rate, (total - done) / rate if rate > 0 else 0.0
