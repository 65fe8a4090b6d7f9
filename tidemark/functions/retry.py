"""Retries with doubling waits."""

from __future__ import annotations

import time
from collections.abc import Callable
from typing import TypeVar

T = TypeVar("T")


def retry(do: Callable[[], T], on: type[BaseException] | tuple[type[BaseException], ...], attempts: int = 5, first_s: float = 5.0, cap_s: float = float("inf"), sleep: Callable[[float], None] = time.sleep) -> T:
    """The result of ``do``; errors of the kinds ``on`` are tried again, others and the last pass through."""
    for k in range(attempts - 1):
        try:
            return do()
        except on:
            sleep(min(cap_s, first_s * 2**k))
    return do()
