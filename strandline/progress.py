"""Milestones of a running job, from Spark's own task counts."""

from __future__ import annotations

import logging
import threading
from collections.abc import Callable

from pyspark.sql import SparkSession

log = logging.getLogger("strandline")


def milestones(done: int, total: int, said: int) -> list[int]:
    """Tenths, in per cent, that have been passed since ``said``."""
    now = 0 if not total else 100 * done // total // 10 * 10
    return list(range(said + 10, now + 1, 10))


class Progress:
    """While it is entered, says each tenth of the tasks of the active stages; a new set of stages begins anew."""

    def __init__(self, spark: SparkSession, say: Callable[[str], None] = log.info, every: float = 1.0):
        self.tracker, self.say, self.every = spark.sparkContext.statusTracker(), say, every
        self.stop = threading.Event()
        self.thread = threading.Thread(target=self._watch, daemon=True)

    def _watch(self) -> None:
        stages: tuple = ()
        said = 0
        while not self.stop.wait(self.every):
            now = tuple(sorted(self.tracker.getActiveStageIds()))
            if now != stages:
                stages, said = now, 0
            found = [x for x in map(self.tracker.getStageInfo, now) if x is not None]
            for m in milestones(sum(x.numCompletedTasks for x in found), sum(x.numTasks for x in found), said):
                self.say(f"stages {', '.join(map(str, now))}: {m} %")
                said = m

    def __enter__(self) -> Progress:
        self.thread.start()
        return self

    def __exit__(self, *_) -> None:
        self.stop.set()
        self.thread.join()
