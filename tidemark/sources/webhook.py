"""A chat webhook."""

from __future__ import annotations

import json
import urllib.request
from collections.abc import Callable


def _post(url: str, body: bytes, timeout: float) -> int:
    request = urllib.request.Request(url, data=body, headers={"Content-Type": "application/json"}, method="POST")
    with urllib.request.urlopen(request, timeout=timeout) as answer:
        return answer.status


def notify(url: str | None, text: str, timeout: float = 10.0, post: Callable[[str, bytes, float], int] = _post) -> bool:
    """Whether a message was taken; False, never an error, if there is no address or it can't be reached."""
    if not (url or "").strip():
        return False
    try:
        return 200 <= post(url, json.dumps({"text": text}).encode(), timeout) < 300
    except Exception:  # noqa: BLE001  an alert must not fail the run
        return False
