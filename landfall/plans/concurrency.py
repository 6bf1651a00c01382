"""Run independent loads as concurrent Spark jobs.

Loads of different tables share nothing but the cluster, so they are
submitted from a bounded thread pool; Spark schedules their jobs side by side,
which keeps executors busy that one small table would leave idle. Results
come back in input order. On the first failure no further load is started,
the running ones finish (each writes its own audit row), and the first error
is raised.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from typing import TypeVar

T = TypeVar("T")


def run_all(tasks: Sequence[Callable[[], T]], max_workers: int = 4) -> list[T]:
    if max_workers <= 1 or len(tasks) <= 1:
        return [t() for t in tasks]
    with ThreadPoolExecutor(max_workers=min(max_workers, len(tasks))) as pool:
        futures = [pool.submit(t) for t in tasks]
        done, pending = wait(futures, return_when=FIRST_EXCEPTION)
        failed = [f for f in futures if f.done() and f.exception() is not None]
        if failed:
            for f in pending:
                f.cancel()
            wait([f for f in pending if not f.cancelled()])
            raise failed[0].exception()
        return [f.result() for f in futures]
