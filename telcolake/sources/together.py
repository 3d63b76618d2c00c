"""Submit independent Spark jobs side by side, so that small tails overlap."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")


def together(jobs: Mapping[str, Callable[[], T]]) -> dict[str, T]:
    """Results by name; the first failure is raised after all jobs have ended."""
    inherit = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(max_workers=max(1, len(jobs))) as pool:
        running = {name: pool.submit(inherit(job)) for name, job in jobs.items()}
    return {name: job.result() for name, job in running.items()}
