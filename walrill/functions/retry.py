"""Trying again, and which failures are worth it."""

from __future__ import annotations

import random
import time
from collections.abc import Callable
from dataclasses import dataclass
from typing import TypeVar

T = TypeVar("T")


class PermanentError(Exception):
    """No repetition helps; the event belongs in quarantine."""


def is_permanent(error: BaseException | None) -> bool:
    """Whether the error or any that it came from is permanent."""
    while error is not None:
        if isinstance(error, PermanentError):
            return True
        error = error.__cause__ or error.__context__
    return False


@dataclass(frozen=True)
class Backoff:
    """Waits double from ``base`` to ``most`` seconds, each shortened by a fifth at random at most, one millisecond at least."""

    base: float = 0.1
    most: float = 2.0
    attempts: int = 20

    def plain(self, attempt: int) -> float:
        return min(self.most, self.base * 2.0 ** min(attempt - 1, 60))

    def wait(self, attempt: int) -> float:
        delay = self.plain(attempt)
        return max(0.001, delay - random.uniform(0, delay / 5))

    def run(self, what: str, f: Callable[[], T], sleep: Callable[[float], None] = time.sleep) -> T:
        for attempt in range(1, self.attempts + 1):
            try:
                return f()
            except Exception as error:
                if is_permanent(error):
                    raise
                if attempt >= self.attempts:
                    raise RuntimeError(f"{what}: {error}") from error
                sleep(self.wait(attempt))
        raise AssertionError


def fence_key(name: str) -> int:
    """The 64-bit FNV-1a hash of a stream's name as a signed number, for an advisory lock."""
    h = 0xCBF29CE484222325
    for b in name.encode():
        h = ((h ^ b) * 0x100000001B3) & (2**64 - 1)
    return h - 2**64 if h >= 2**63 else h
