"""Named datasets: staged tables, unified postings, marts, and the job that stores them."""

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Any


def side_by_side(jobs: dict[str, Callable[[], Any]], at_once: int = 8) -> dict[str, Any]:
    """Results of independent Spark jobs, some of them submitted at once, so that small ones don't leave the
    executors idle. All are tried; the first error is raised when they are done."""
    with ThreadPoolExecutor(at_once) as pool:
        running = {name: pool.submit(job) for name, job in jobs.items()}
    return {name: each.result() for name, each in running.items()}
