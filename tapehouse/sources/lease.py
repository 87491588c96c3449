"""One run at a time: a lease file beside the lake, taken by compare-and-set and renewed while held."""

from __future__ import annotations

import json
import threading
import time
import uuid

from pyspark.sql import SparkSession

from tapehouse.sources.versions import Folders

LEASE = "_lease.json"
SECONDS = 600.0


class Busy(RuntimeError):
    """Another run holds the lease."""


class Lost(RuntimeError):
    """The lease expired and another run took it."""


class Lease:
    """Context manager: ``with Lease(spark, lake.root):`` runs alone or raises ``Busy``.

    A run that dies leaves its lease behind; it can be taken once its time is
    over. The one that takes it first moves the old file away, which only one
    can do. ``check`` raises ``Lost`` in a run that was taken for dead.
    """

    def __init__(self, spark: SparkSession, root: str, seconds: float = SECONDS, holder: str | None = None):
        self.io = Folders(spark, root)
        self.place, self.seconds = f"{root.rstrip('/')}/{LEASE}", seconds
        self.holder = holder or uuid.uuid4().hex
        self._end = threading.Event()
        self._thread: threading.Thread | None = None
        self._lost = False

    def _text(self) -> str:
        return json.dumps({"holder": self.holder, "until": time.time() + self.seconds})

    def acquire(self) -> None:
        if self.io.publish(self.place, self._text()):
            return
        held = self.io.read(self.place)
        if held is not None:
            state = json.loads(held)
            if state["until"] > time.time():
                raise Busy(f"{self.place} is held by {state['holder']} until {state['until']:.0f}")
            gone = f"{self.place}.{uuid.uuid4().hex}.expired"
            if self.io.move(self.place, gone):
                self.io.delete(gone)
        if not self.io.publish(self.place, self._text()):
            raise Busy(f"{self.place} was taken by another run")

    def check(self) -> None:
        held = self.io.read(self.place)
        if self._lost or held is None or json.loads(held)["holder"] != self.holder:
            raise Lost(f"{self.place} is no longer held by {self.holder}")

    def renew(self) -> None:
        self.check()
        self.io.publish(self.place, self._text(), replace=True)

    def release(self) -> None:
        held = self.io.read(self.place)
        if held is not None and json.loads(held)["holder"] == self.holder:
            self.io.delete(self.place)

    def _keep(self) -> None:
        while not self._end.wait(self.seconds / 3):
            try:
                self.renew()
            except Lost:
                self._lost = True
                return

    def __enter__(self) -> Lease:
        self.acquire()
        self._thread = threading.Thread(target=self._keep, daemon=True, name="lake-lease")
        self._thread.start()
        return self

    def __exit__(self, *_) -> None:
        self._end.set()
        self._thread.join()
        self.release()
