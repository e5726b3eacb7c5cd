"""Bounded retries with random exponential waits, for calls to outside services."""

from __future__ import annotations

import random
import time
from collections.abc import Callable
from dataclasses import dataclass
from typing import TypeVar

R = TypeVar("R")


@dataclass(frozen=True)
class Retry:
    """At most ``attempts`` tries; waits are drawn up to a doubling bound within the limits."""

    attempts: int
    shortest: float
    longest: float

    def call(self, action: Callable[[], R], sleep: Callable[[float], None] = time.sleep) -> R:
        for attempt in range(1, self.attempts + 1):
            try:
                return action()
            except Exception:
                if attempt == self.attempts:
                    raise
                bound = min(self.longest, self.shortest * 2**attempt)
                sleep(random.uniform(self.shortest, max(self.shortest, bound)))
        raise AssertionError("unreachable")


# Attempts and wait limits in seconds.
EMBED_RETRY = Retry(6, 1, 20)
UPSERT_RETRY = Retry(3, 1, 20)
COLLECTION_RETRY = Retry(6, 10, 120)
