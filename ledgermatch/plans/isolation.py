"""Queries that run at the same time and fail alone.

Each query is built and run in a driver thread of its own under a Spark job
group. Where the session schedules fairly (``spark.scheduler.mode=FAIR``, which
``build_session`` sets), the threads share the executors evenly through one
pool; otherwise their jobs queue. A query that raises, or that runs longer than
its time limit, is a ``Failed`` answer: the limit cancels the jobs of its group
and no others.
"""

from __future__ import annotations

import re
import threading
import time
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Row, SparkSession

POOL = "ledgermatch-suite"


@dataclass(frozen=True)
class Failed:
    """Why a query has no answer."""
    message: str
    timed_out: bool = False


# an error condition and its message, wherever a chain of causes has it
_CONDITION = re.compile(r"\[[A-Z][A-Z0-9_.]+\][^\n]*")


def _one_line(exc: Exception) -> str:
    text = str(exc).strip()
    found = sorted(_CONDITION.findall(text), key=lambda c: c.startswith("[STAGE_MATERIALIZATION"))     # one that names several says least
    return f"{type(exc).__name__}: {found[0] if found else text.splitlines()[0] if text else ''}"


def first_rows(spark: SparkSession, queries: Mapping[str, Callable[[], DataFrame]], limit_sec: float | None = None,
               workers: int = 4, many: bool = False) -> dict[str, Row | list[Row] | Failed]:
    """The first row (with ``many`` all rows) of each query, ``workers`` at a time.

    Answers are result rows of checks, one per query, so they are small.
    """
    sc = spark.sparkContext

    def run(name: str, make: Callable[[], DataFrame]):
        group, done, late = f"{POOL}-{uuid.uuid4().hex}", threading.Event(), threading.Event()
        sc.setJobGroup(group, f"suite query {name}", interruptOnCancel=True)
        sc.setLocalProperty("spark.scheduler.pool", POOL)

        def watch():   # a plan may start further jobs after the first is cancelled
            if not done.wait(limit_sec):
                late.set()
                while not done.is_set():
                    sc.cancelJobGroup(group)
                    done.wait(0.5)

        if limit_sec is not None:
            threading.Thread(target=watch, daemon=True).start()
        began = time.monotonic()
        try:
            df = make()
            answer = df.collect() if many else df.first()
        except (PySparkException, Py4JJavaError, ValueError, KeyError, IndexError) as exc:
            if late.is_set():
                return Failed(f"stopped after {time.monotonic() - began:.0f} s, the limit is {limit_sec:g} s", True)
            return Failed(_one_line(exc))
        finally:
            done.set()
            sc.setLocalProperty("spark.scheduler.pool", None)
            sc.setLocalProperty("spark.jobGroup.id", None)
        return answer

    with ThreadPoolExecutor(max_workers=max(1, workers)) as pool:
        running = {name: pool.submit(run, name, make) for name, make in queries.items()}
        return {name: f.result() for name, f in running.items()}
