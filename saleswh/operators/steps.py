"""Steps of a load that wait for each other only where they have to."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait

from pyspark.sql import SparkSession

Step = tuple[Sequence[str], Callable[[], object]]


def run_steps(spark: SparkSession, steps: Mapping[str, Step]) -> dict[str, object]:
    """Runs every step once those it names are done; returns what each gave.

    Steps that do not wait for each other run at the same time, each in a
    scheduler pool of its own, so with the FAIR scheduler none starves another.
    The first error cancels the jobs of all steps and is raised; steps that have
    not begun then never do.
    """
    context = spark.sparkContext
    tag = f"load-{uuid.uuid4().hex}"

    def run(name: str) -> object:
        context.addJobTag(tag)
        context.setLocalProperty("spark.scheduler.pool", name)
        try:
            return steps[name][1]()
        finally:
            context.setLocalProperty("spark.scheduler.pool", None)
            context.removeJobTag(tag)

    done: dict[str, object] = {}
    running: dict[Future, str] = {}
    waiting = dict(steps)
    with ThreadPoolExecutor(max(1, len(steps))) as pool:
        while waiting or running:
            ready = [name for name, (needs, _) in waiting.items() if all(need in done for need in needs)]
            if not ready and not running:
                raise ValueError(f"steps wait for something that never comes: {sorted(waiting)}")
            for name in ready:
                del waiting[name]
                running[pool.submit(run, name)] = name
            finished, _ = wait(running, return_when=FIRST_COMPLETED)
            failed = [job for job in finished if job.exception()]
            if failed:
                context.cancelJobsWithTag(tag)
                wait(running)
                raise failed[0].exception()
            for job in finished:
                done[running.pop(job)] = job.result()
    return done
