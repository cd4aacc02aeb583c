"""Wall time of a plan's stages."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame

from kinmatch.sources.shared import written


def timed(source: DataFrame, stages: Iterable[tuple[str, Callable[[DataFrame], DataFrame]]]) -> list[tuple[str, float, int]]:
    """(stage, seconds, rows) of stages that follow one another, each written to the shared folder and read by the next, so
    that a stage's time is its own."""
    out, df = [], source
    for name, stage in stages:
        began = time.monotonic()
        df = written(stage(df), f"profile-{name}")
        out.append((name, time.monotonic() - began, df.count()))
    return out
