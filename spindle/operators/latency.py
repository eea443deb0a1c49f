"""Timing of queries: a warm-up, then the median of several runs, and the plan's parts."""

from __future__ import annotations

import re
import time
from collections import Counter
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from statistics import median

from pyspark.sql import DataFrame


@dataclass
class Timing:
    label: str
    model: str
    seconds: float
    runs: list[float]
    rows: int
    parts: dict[str, int] = field(default_factory=dict)

    def to_dict(self) -> dict:
        return asdict(self)


def plan_parts(df: DataFrame) -> dict[str, int]:
    """How often each physical operator occurs."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return dict(Counter(re.findall(r"(?m)^[\s:+\-*()\d]*([A-Z][A-Za-z]+)\b", text)))


def timed(make: Callable[[], DataFrame], label: str, model: str = "", runs: int = 3) -> Timing:
    """The whole result is computed and thrown away, on the executors."""
    rows = make().count()
    took = []
    for _ in range(runs):
        began = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        took.append(time.perf_counter() - began)
    return Timing(label, model, median(took), took, rows, plan_parts(make()))


def compare(label: str, models: dict[str, Callable[[], DataFrame]], runs: int = 3) -> list[Timing]:
    """The same question asked of several table models, the fastest first."""
    return sorted((timed(make, label, name, runs) for name, make in models.items()), key=lambda t: t.seconds)
