"""Jobs that do not depend on each other, side by side."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

#: Jobs at a time: one alone leaves cores idle while it is planned and while its last tasks run.
AT_ONCE = 4


def together(jobs: Sequence[Callable]) -> list:
    """The results of ``jobs`` in their order; all have ended when the first error is raised."""
    if len(jobs) < 2:
        return [job() for job in jobs]
    inheriting = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(AT_ONCE) as pool:
        started = [pool.submit(inheriting(job)) for job in jobs]
    return [s.result() for s in started]
