"""Trials as schedulable Spark jobs (H8, H9).

Every task of a trial (a fold, say) runs in a driver thread of its own that
carries the session's local properties, with the trial's job tag and its own
scheduler pool: under ``spark.scheduler.mode=FAIR`` trials share the executors
evenly, and at most ``parallelism`` tasks are submitted at once. Jobs are
cancelled by tag: those of a trial of which one task failed, and those of a trial
that takes longer than ``timeout`` seconds. Other trials go on.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession
from pyspark.util import inheritable_thread_target


class TrialCancelled(RuntimeError):
    """A trial ended by its time limit."""


def run_trials(spark: SparkSession, tasks: list[list[Callable]], parallelism: int = 4,
               timeout: float | None = None) -> list[tuple[list | None, BaseException | None]]:
    """Run the tasks (callables without arguments) of each trial. Returns per
    trial its tasks' results in order, or the first error."""
    sc, run = spark.sparkContext, uuid.uuid4().hex[:8]
    lock, begun, errors, late = threading.Lock(), {}, {}, set()
    results: list[list] = [[None] * len(t) for t in tasks]
    tags = [f"trial-{run}-{i}" for i in range(len(tasks))]

    def fail(i, e):
        with lock:
            errors.setdefault(i, e)
        sc.cancelJobsWithTag(tags[i])

    def one(i, j):
        with lock:
            if i in errors:
                return
            begun.setdefault(i, time.monotonic())
        sc.setLocalProperty("spark.scheduler.pool", tags[i])
        sc.addJobTag(tags[i])
        try:
            results[i][j] = tasks[i][j]()
        except Exception as e:  # noqa: BLE001 - a failed trial is recorded, not fatal
            fail(i, TrialCancelled(f"trial {i} took more than {timeout} s") if i in late else e)
        finally:
            sc.removeJobTag(tags[i])
            sc.setLocalProperty("spark.scheduler.pool", None)

    over = threading.Event()

    def watch():
        while not over.wait(0.2):
            now = time.monotonic()
            with lock:
                slow = [i for i, t in begun.items() if i not in errors and i not in late and now - t > timeout and i not in ended()]
                late.update(slow)
            for i in slow:
                fail(i, TrialCancelled(f"trial {i} took more than {timeout} s"))

    left = {i: len(t) for i, t in enumerate(tasks)}

    def ended():
        return {i for i, n in left.items() if n == 0}

    def counted(i, j):
        try:
            one(i, j)
        finally:
            with lock:
                left[i] -= 1

    guard = threading.Thread(target=watch, daemon=True) if timeout else None
    if guard:
        guard.start()
    try:
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            for f in [pool.submit(inheritable_thread_target(spark)(lambda i=i, j=j: counted(i, j)))
                      for i, t in enumerate(tasks) for j in range(len(t))]:
                f.result()
    finally:
        over.set()
    return [(None, errors[i]) if i in errors else (results[i], None) for i in range(len(tasks))]
