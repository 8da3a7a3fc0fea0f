"""Run log of the jobs: append-only events, one STARTED and one final row per run."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanflux import constants as K
from urbanflux import schemas
from urbanflux.functions.keys import utc_now

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Counts:
    """Rows a job read and wrote; counts of the steps of a job add up."""

    read: int = 0
    written: int = 0

    def __add__(self, other: Counts) -> Counts:
        return Counts(self.read + other.read, self.written + other.written)


class StepsFailed(Exception):
    """Some steps of a job failed; ``counts`` are those of the steps that did not."""

    def __init__(self, errors: list[Exception], counts: Counts):
        super().__init__("; ".join(str(e) for e in errors))
        self.errors, self.counts = errors, counts


def run_steps(*steps: Callable[[], Counts]) -> Counts:
    """Run independent steps one after the other; what fails is raised after the last one."""
    counts, errors = Counts(), []
    for step in steps:
        try:
            counts += step()
        except Exception as error:
            log.exception("a step failed")
            errors.append(error)
    if errors:
        raise StepsFailed(errors, counts) from errors[0]
    return counts


def run_audited(
    spark: SparkSession,
    job_name: str,
    job: Callable[[], Counts],
    append: Callable[[DataFrame], None],
) -> Counts:
    """Run ``job`` between a STARTED row and a SUCCESS or FAILED row.

    A failure is recorded, with the counts of the steps that succeeded, and raised again, so that
    a scheduler sees it.
    """
    run_id, start = uuid.uuid4().hex, utc_now()

    def record(status: str, end: datetime | None, counts: Counts, error: str | None) -> None:
        row = (
            run_id, job_name, status, start, end, counts.read, counts.written, error, start.date()
        )
        append(spark.createDataFrame([row], schemas.ETL_AUDIT_LOG).coalesce(1))

    record(K.STARTED, None, Counts(), None)
    try:
        counts = job()
    except Exception as error:
        done = error.counts if isinstance(error, StepsFailed) else Counts()
        record(K.FAILED, utc_now(), done, str(error))
        raise
    record(K.SUCCESS, utc_now(), counts, None)
    return counts


def latest_state(
    events: DataFrame, run: str = "run_id", order: list[str] | None = None
) -> DataFrame:
    """The last event of each run; a final row outranks the STARTED row it follows."""
    order_columns = order or ["_final", "end_time"]
    if order is None:
        events = events.withColumn("_final", F.col("status") != K.STARTED)
    rest = [c for c in events.columns if c != run and c not in order_columns]
    last = events.groupBy(run).agg(F.max(F.struct(*order_columns, *rest)).alias("_last"))
    return last.select(
        *[
            F.col(run) if c == run else F.col("_last").getField(c).alias(c)
            for c in events.columns
            if c != "_final"
        ]
    )
