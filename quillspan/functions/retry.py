"""Retry schedules for sources that are fetched over a network."""

from __future__ import annotations

import random
import time
from collections.abc import Callable
from email.utils import parsedate_to_datetime


def delay(attempt: int, base: float = 1.0, cap: float = 8.0, jitter: float = 0.0, rnd: Callable[[], float] = random.random) -> float:
    """Seconds before retry `attempt` (0 is the first): base * 2 ** attempt up to cap, plus up to `jitter` of that."""
    wait = min(base * 2**attempt, cap)
    return wait + wait * jitter * rnd()


def retry_after(header: str | None, now: float) -> float | None:
    """Seconds that a Retry-After header asks for, as a number or a date."""
    if not header:
        return None
    try:
        return max(0.0, float(header))
    except ValueError:
        pass
    try:
        return max(0.0, parsedate_to_datetime(header).timestamp() - now)
    except (TypeError, ValueError):
        return None


class NotFound(Exception):
    """Never worth a retry."""


class Limited(Exception):
    def __init__(self, header: str | None = None):
        self.header = header


def call(fn: Callable[[], object], retries: int = 3, sleep: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.time, **schedule) -> object:
    """fn() with retries after any error but NotFound; a Limited error's header overrides the schedule."""
    for attempt in range(retries + 1):
        try:
            return fn()
        except NotFound:
            raise
        except Exception as e:
            if attempt == retries:
                raise
            asked = retry_after(e.header, clock()) if isinstance(e, Limited) else None
            sleep(delay(attempt, **schedule) if asked is None else asked)
    raise AssertionError
