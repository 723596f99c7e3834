"""Exponential back-off with repeatable jitter."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: longest wait between two attempts, ten minutes.
MAX_BACKOFF_MS = 600000


def unit_draw(*cols: Column) -> Column:
    """A number in [-1, 1) that depends on the given columns only, so a rerun
    after a lost executor draws the same."""
    steps = F.pmod(F.xxhash64(*cols), F.lit(2**52)).cast("double")
    return steps / F.lit(float(2**51)) - F.lit(1.0)


def backoff_ms(
    attempt: Column,
    base_ms: int,
    multiplier: float = 2.0,
    jitter: float = 0.3,
    draw: Column | None = None,
) -> Column:
    """Wait after failure number ``attempt``; the cap comes after the jitter.

    ``draw`` is a column in [-1, 1); without it there is no jitter.
    """
    jitter = min(1.0, max(0.0, jitter))
    # Doubles clamp before the cast: a large power must not overflow the long.
    raw = F.lit(float(base_ms)) * F.pow(F.lit(float(multiplier)), attempt - 1)
    grown = F.floor(F.least(raw, F.lit(float(2**53)))).cast("long")
    wait = grown
    if draw is not None and jitter > 0:
        shift = draw * (grown.cast("double") * F.lit(jitter))
        wait = grown + (F.signum(shift) * F.floor(F.abs(shift))).cast("long")
    return F.least(F.greatest(wait, F.lit(1).cast("long")), F.lit(MAX_BACKOFF_MS).cast("long"))


def backoff_schedule(
    message_id: Column,
    max_retries: int,
    base_ms: int,
    multiplier: float = 2.0,
    jitter: float = 0.3,
    seed: int = 0,
) -> Column:
    """Waits after failure 1 .. max_retries-1 of a message, as an array."""
    waits = [
        backoff_ms(
            F.lit(attempt), base_ms, multiplier, jitter,
            unit_draw(message_id, F.lit(attempt), F.lit(seed)),
        )
        for attempt in range(1, max(1, max_retries))
    ]
    return F.array(*waits) if waits else F.array().cast("array<bigint>")
