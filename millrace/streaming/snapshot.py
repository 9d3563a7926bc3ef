"""A table snapshot that is read again once it is too old."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame


class Snapshot:
    """Holds the result of ``load`` for at most ``max_staleness`` seconds.

    Zero re-reads at every use.  A held snapshot is persisted across executors; blocks
    of a lost executor are computed again from the source.
    """

    def __init__(
        self,
        load: Callable[[], DataFrame],
        max_staleness: float = 0.0,
        clock: Callable[[], float] = time.monotonic,
    ):
        self._load, self._max, self._clock = load, max_staleness, clock
        self._frame: DataFrame | None = None
        self._read_at = 0.0

    def get(self) -> DataFrame:
        if self._max <= 0:
            return self._load()
        if self._frame is None or self._clock() - self._read_at >= self._max:
            self.invalidate()
            self._frame = self._load().persist(StorageLevel.MEMORY_AND_DISK)
            self._read_at = self._clock()
        return self._frame

    def invalidate(self) -> None:
        """Forget the held snapshot."""
        if self._frame is not None:
            self._frame.unpersist()
            self._frame = None
