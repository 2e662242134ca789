"""Submit independent Spark jobs (fits of different folds, classes or
parameter values) from a small driver thread pool; Spark schedules them
concurrently on the executors. Each fit keeps its own copy of its rows in the
executors' storage memory (Spark's trees and solvers do), so as many run
together as find room there; beyond that copies would evict one another."""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import SparkSession

T = TypeVar("T")
R = TypeVar("R")

#: Part of the storage memory that copies may fill, and bytes of a copied row beside 8 per feature.
ROOM, ROW_BYTES = 0.7, 160
_LOCAL = threading.local()


def _share() -> int:
    """How many threads of :func:`pmap` the caller runs beside, itself included."""
    return getattr(_LOCAL, "share", 1)


def pmap(fn: Callable[[T], R], items: Iterable[T], workers: int = 4) -> list[R]:
    items = list(items)
    if len(items) <= 1 or workers <= 1:
        return [fn(x) for x in items]
    n = min(workers, len(items))
    share = _share() * n
    with ThreadPoolExecutor(max_workers=n, initializer=lambda: setattr(_LOCAL, "share", share)) as ex:
        return list(ex.map(fn, items))


def storage_bytes(spark: SparkSession) -> int:
    """Storage memory of all executors (of the driver where it is the only one)."""
    sc = spark.sparkContext._jsc.sc()
    driver, found, it = sc.env().blockManager().blockManagerId().hostPort(), {}, sc.getExecutorMemoryStatus().iterator()
    while it.hasNext():
        kv = it.next()
        found[kv._1()] = kv._2()._1()
    return sum(v for at, v in found.items() if at != driver or len(found) == 1)


def fits_at_once(spark: SparkSession, rows: int, width: int) -> int:
    """How many fits over ``rows`` rows of ``width`` features have room for their copies together; one at least."""
    return max(1, int(ROOM * storage_bytes(spark) / _share() / max(1, rows * (8 * width + ROW_BYTES))))
