"""Value -> category by inclusive ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Band = tuple[str, float | int | None, float | int | None]


def band_of(value: Column, bands: Sequence[Band]) -> Column:
    """First band whose inclusive [low, high] holds ``value``; no match -> NULL.

    ``None`` as low/high is an open end.
    """
    expr = None
    for name, low, high in bands:
        cond = F.lit(True)
        if low is not None:
            cond = cond & (value >= F.lit(low))
        if high is not None:
            cond = cond & (value <= F.lit(high))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(None).cast("string"))
