"""Trying again."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from typing import TypeVar

T = TypeVar("T")
log = logging.getLogger(__name__)


def resilient(call: Callable[[], T], tries: int = 10, pause: float = 10, default: T | None = None, sleep: Callable[[float], None] = time.sleep) -> T | None:
    """What call gives; after so many failures, with pauses between, a log line and the default."""
    for k in range(tries):
        try:
            return call()
        except Exception as e:  # noqa: BLE001  any failure is tried again
            log.info("try %d of %d failed: %s", k + 1, tries, e)
            if k + 1 < tries:
                sleep(pause)
    log.warning("gave up after %d tries", tries)
    return default
