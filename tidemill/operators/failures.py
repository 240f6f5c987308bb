"""Failures: which are worth a retry, and how long to wait before it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Kinds that no retry can mend, and transport codes that one may.
FINAL = ("config", "schema", "value", "state", "aborted")
OWN = ("transport", "server", "timeout", "bulk")
TRANSIENT_CODES = (2, 4, 8, 10, 14)


def retriable(kind: Column, code: Column, mode: str = "aggressive") -> Column:
    """``aggressive``: all of our own failures but final ones; ``conservative``: time-outs, and transport failures with a transient code. Foreign failures never."""
    if mode == "aggressive":
        return F.coalesce(kind.isin(*OWN), F.lit(False))
    if mode == "conservative":
        return F.coalesce((kind == "timeout") | ((kind == "transport") & code.isin(*TRANSIENT_CODES)), F.lit(False))
    raise ValueError(f"unknown mode {mode!r}")


def backoff(attempt: Column, initial: float = 100.0, most: float = 10_000.0, factor: float = 2.0) -> Column:
    """Milliseconds before attempt ``attempt`` (from 0): exponential up to ``most``."""
    return F.least(F.lit(float(most)), F.lit(float(initial)) * F.pow(F.lit(float(factor)), attempt))


def jittered(delay: Column, seed: int | None = None) -> Column:
    """A uniform draw from [0, delay)."""
    return F.rand(seed) * delay
