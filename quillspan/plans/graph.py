"""A run of several children at once: each is a thread with a job tag of its own, waited for, counted, and cancelled alone."""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark import InheritableThread
from pyspark.sql import SparkSession

from quillspan.operators.control import Control

RUNNING, COMPLETE, FAILED, CANCELLED, WAITING = "running", "complete", "error", "cancelled", "waiting"


@dataclass
class Child:
    name: str
    make: Callable[[], object]
    steps: list[str]
    tag: str
    status: str = WAITING
    result: object = None
    error: str | None = None
    stop: threading.Event = field(default_factory=threading.Event)


class RunGraph:
    """Children under one run. together: how many run at once; their Spark jobs share the cluster by its scheduler.

    The status of each is kept in the control folder, so another driver sees it. A child that fails or is cancelled costs the others
    nothing; a cancelled one's steps are removed, a failed one's stay, so that it goes on after them.
    """

    def __init__(self, spark: SparkSession, control: Control, run: str, together: int = 4):
        self.spark, self.control, self.run, self.room = spark, control, run, threading.Semaphore(together)
        self.children: dict[str, Child] = {}
        self.threads: list[InheritableThread] = []
        self.lock = threading.Lock()

    def add(self, name: str, make: Callable[[], object], steps: list[str] | None = None) -> None:
        """steps: the folders that hold the child's steps, by default the one of its name."""
        self.children[name] = Child(name, make, steps or [name], f"{self.run}-{name}-{uuid.uuid4().hex[:8]}")

    def start(self) -> RunGraph:
        for child in self.children.values():
            self._say(child, WAITING)
            self.threads.append(InheritableThread(target=self._work, args=(child,)))
        for t in self.threads:
            t.start()
        return self

    def wait(self, timeout: float | None = None) -> dict[str, str]:
        """Status of each child, once all have ended or the time is over."""
        until = None if timeout is None else time.monotonic() + timeout
        for t in self.threads:
            t.join(None if until is None else max(0.0, until - time.monotonic()))
        return {c.name: c.status for c in self.children.values()}

    def cancel(self, name: str) -> bool:
        """Stop a child's jobs and keep it from starting more; whether it was still to end."""
        child = self.children[name]
        if child.status not in (RUNNING, WAITING):
            return False
        child.stop.set()
        self.spark.sparkContext.cancelJobsWithTag(child.tag)
        return True

    def results(self) -> dict[str, object]:
        return {c.name: c.result for c in self.children.values() if c.status == COMPLETE}

    def errors(self) -> dict[str, str]:
        return {c.name: c.error or c.status for c in self.children.values() if c.status in (FAILED, CANCELLED)}

    def _work(self, child: Child) -> None:
        with self.room:
            self.spark.sparkContext.addJobTag(child.tag)  # this thread's jobs alone
            try:
                if child.stop.is_set():
                    raise InterruptedError
                self._say(child, RUNNING)
                watch = threading.Thread(target=self._watch, args=(child,), daemon=True)
                watch.start()
                child.result = child.make()
                status = CANCELLED if child.stop.is_set() else COMPLETE
            except BaseException as e:  # noqa: BLE001
                child.error = f"{type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}"
                status = CANCELLED if child.stop.is_set() else FAILED
            finally:
                self.spark.sparkContext.removeJobTag(child.tag)
            if status == CANCELLED:
                child.result = None
                for folder in child.steps:
                    self.control.clear(folder)
            self._say(child, status)

    def _watch(self, child: Child) -> None:
        """A cancelled child may be between two jobs: what it starts later is cancelled too."""
        while child.status == RUNNING:
            if child.stop.wait(0.2) and child.status == RUNNING:
                self.spark.sparkContext.cancelJobsWithTag(child.tag)
                time.sleep(0.2)

    def _say(self, child: Child, status: str) -> None:
        with self.lock:
            child.status = status
            self.control.put(f"runs/{self.run}/{child.name}", {"status": status, "error": child.error})
