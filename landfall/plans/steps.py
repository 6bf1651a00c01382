"""Ordered SQL steps, each published as a table before the next one runs.

A step is one Spark SQL statement; its result is written as a new version of
the table named after the step and registered as a temporary view of that
name, so later steps can read it. Writing each step cuts the lineage: a later
failure or a lost executor never recomputes earlier steps.

On a failing step its audit row gets status 0, earlier steps stay published,
and later steps do not run (the exception is re-raised as :class:`StepFailed`).
A step whose name is that of a view that no step made (a source's table) leaves
that view alone; it is then found as ``<prefix>_<step>`` (``erp_a_tf_orders``), as
every step is. If a later step uses the bare name, which of the two it means is
not known, and the step fails before it writes anything.
"""

from __future__ import annotations

import logging
import os
import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from landfall.sources.jdbc import clean_query
from landfall.tables.store import LoadResult, TableStore

log = logging.getLogger(__name__)

#: (application, view) of the views that steps made; a step may replace these.
_step_views: set[tuple[str, str]] = set()


@dataclass(frozen=True)
class Step:
    name: str
    sql: str


class StepFailed(RuntimeError):
    def __init__(self, step: str, done: list[LoadResult], cause: BaseException):
        super().__init__(f"step {step!r} failed: {cause}")
        self.step = step
        self.done = done
        self.__cause__ = cause


def steps_from_dir(directory: str) -> list[Step]:
    """``*.sql`` files in sorted order; an empty folder gives no steps."""
    steps = []
    for name in sorted(os.listdir(directory)):
        if name.endswith(".sql"):
            with open(os.path.join(directory, name), encoding="utf-8") as fh:
                steps.append(Step(name[: -len(".sql")], fh.read()))
    if not steps:
        log.warning("no .sql files in %s", directory)
    return steps


def view_name(table: str) -> str:
    return table.replace(".", "_")


def run_steps(
    spark: SparkSession,
    store: TableStore,
    steps: Sequence[Step] | Iterable[Step],
    *,
    layer: str = "dwh",
    source: str | None = None,
    prefix: str = "",
) -> list[LoadResult]:
    done: list[LoadResult] = []
    steps = list(steps)
    for i, step in enumerate(steps):
        table, name = f"{prefix}{step.name}", view_name(step.name)
        taken = (spark.sparkContext.applicationId, name) not in _step_views and spark.catalog.tableExists(name)
        users = [s.name for s in steps[i + 1 :] if taken and uses(s, name)]

        def rows(step: Step = step, name: str = name, users: Sequence[str] = users) -> DataFrame:
            if users:
                raise ValueError(f"{name!r} is a view already, and {users} use the name: rename the step")
            return spark.sql(clean_query(step.sql))

        try:
            result = store.publish(rows, table, "refresh", layer=layer, source=source)
        except Exception as exc:
            raise StepFailed(step.name, done, exc) from exc
        published = store.read(table)
        published.createOrReplaceTempView(view_name(table))
        if not taken:
            published.createOrReplaceTempView(name)
            _step_views.add((spark.sparkContext.applicationId, name))
        done.append(result)
    return done


def uses(step: Step, name: str) -> bool:
    """Whether a step's text has the bare name as a word."""
    return re.search(rf"(?<![\w.`]){re.escape(name)}(?!\w)", step.sql, re.IGNORECASE) is not None
