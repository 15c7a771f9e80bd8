"""Running a collection in batches: limits, recovery, a single writer, the queue of missing details.

The state is one small document; only the loop and this document live on the driver.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.operators.grid import advance

#: The daily run: one page filter, two pages a search, no details.
DAILY = {"filters": ("past_24h",), "max_pages": 2, "details": 0}


def recovered(state: dict, summary: dict) -> dict:
    """State after a failed batch: as far as the last summary says that the batch came, never back."""
    reached = min(int(state["total"]), int(summary.get("latest_run_partition_offset") or 0) + int(summary.get("latest_run_searches_attempted") or 0))
    return {**state, "next": max(int(state["next"]), reached)}


def run_batches(
    state: dict, batch: Callable[[int, int], dict], size: int, count: Callable[[], int], save: Callable[[dict], None] = lambda s: None, summary: Callable[[], dict] = dict, target: int | None = None,
    max_batches: int | None = 1, max_seconds: float | None = None, cycle: bool = False, clock: Callable[[], float] = time.monotonic,
) -> tuple[dict, str]:
    """Run batches of at most ``size`` cells from the state's place on; the state at the end and why it ended.

    Ends when ``target`` rows are there, the grid is done (unless ``cycle``), the time or the number of
    batches (none: no limit) is used up.  The state is saved after each batch.  A batch that fails
    is passed over as far as the last summary shows progress; without progress its error is raised.
    """
    began, done = clock(), 0
    try:
        while True:
            before = count()
            if target is not None and before >= target:
                return state, "target"
            if state["next"] >= state["total"]:
                state = {**state, "cycles": int(state.get("cycles", 0)) + 1}
                if not cycle or not state["total"]:
                    return state, "complete"
                state = {**state, "next": 0}
            if max_seconds is not None and clock() - began >= max_seconds:
                return state, "time"
            if max_batches is not None and done >= max_batches:
                return state, "batches"
            offset = int(state["next"])
            length = min(size, int(state["total"]) - offset)
            record = {"offset": offset, "size": length, "jobs_before": before}
            try:
                batch(offset, length)
            except Exception as e:
                state = recovered(state, summary())
                state = {**state, "history": [*state.get("history", []), {**record, "jobs_after": count(), "error": str(e)}][-50:]}
                save(state)
                if state["next"] <= offset:
                    raise
                continue
            done += 1
            after = count()
            state = advance(state, {**record, "attempted": length, "jobs_after": after, "new_jobs": after - before})
            save(state)
    finally:
        save(state)


@contextmanager
def single_writer(spark: SparkSession, path: str) -> Iterator[bool]:
    """Whether this run may write: false where another one holds the lock file, which is made in one step and removed at the end."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    files = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    mine = files.createNewFile(p)
    try:
        yield mine
    finally:
        if mine:
            files.delete(p, False)


def status_of(ran: bool, other_running: bool, failed: bool = False) -> str:
    """How a daily run ended: ``completed``, ``failed``, or ``skipped`` while a full run is on."""
    return "skipped" if other_running or not ran else "failed" if failed else "completed"


def needs_detail(description: Column, least: int = 80) -> Column:
    """Whether a row lacks a description of at least so many characters."""
    from postlens.functions.text import normalize_space

    return F.length(normalize_space(description)) < least


def backfill_queue(rows: DataFrame, order: str, most: int, job_id: str = "linkedin_job_id", description: str = "description") -> DataFrame:
    """The first ``most`` rows with an id and without description, in order: what the next run fetches (its feature is the limit)."""
    return rows.where(F.trim(F.coalesce(F.col(job_id), F.lit(""))) != "").where(needs_detail(F.col(description))).orderBy(order).limit(most)


def with_previous(stats: DataFrame, previous: DataFrame, path: str = "path") -> DataFrame:
    """Merge statistics (path, n_rows, n_net_new) in which an input that brings nothing new and is as large as
    in the previous run keeps that run's ``n_net_new``: merging again reports the same."""
    old = previous.groupBy(F.col(path).alias("_p")).agg(F.max("n_rows").alias("_rows"), F.max("n_net_new").alias("_net"))
    met = stats.join(old, stats[path] == old["_p"], "left")
    again = (F.col("n_net_new") == 0) & (F.col("n_rows") == F.col("_rows"))
    return met.select(path, "n_rows", F.when(again, F.coalesce("_net", F.lit(0))).otherwise(F.col("n_net_new")).alias("n_net_new"))
