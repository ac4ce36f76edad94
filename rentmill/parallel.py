"""Independent Spark jobs submitted side by side."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Name, Result = TypeVar("Name"), TypeVar("Result")

# Enough to keep executors busy through the small tables of a layer.
JOBS_AT_ONCE = 8


def for_each(spark: SparkSession, names: Iterable[Name], act: Callable[[Name], Result]) -> list[Result]:
    """``act`` on every name, several at once. All run even if one fails; then the failure is raised."""
    with ThreadPoolExecutor(JOBS_AT_ONCE) as pool:
        runs = [pool.submit(inheritable_thread_target(spark)(act), name) for name in names]
    return [run.result() for run in runs]
