"""Trigger settings for ``DataStreamWriter.trigger``."""

from __future__ import annotations

from headway.lookups import POLL_SECONDS_DEFAULT, POLL_SECONDS_MAX, POLL_SECONDS_MIN


def poll_every(seconds: int = POLL_SECONDS_DEFAULT) -> dict[str, str]:
    """Continuous polling; the interval is kept between 10 and 30 seconds."""
    clamped = min(max(seconds, POLL_SECONDS_MIN), POLL_SECONDS_MAX)
    return {"processingTime": f"{clamped} seconds"}


def once() -> dict[str, bool]:
    """Take in what is there now, then stop."""
    return {"availableNow": True}
