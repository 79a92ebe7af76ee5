"""Counts taken while a write runs, instead of by a job of their own."""

from __future__ import annotations

import threading
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation


class Counted:
    """A DataFrame that counts its rows as they pass.

    ``rows`` goes into one write; ``counts`` gives the numbers after it. They arrive through Spark's event
    queue, which may drop events on a very busy cluster; ``counts`` is then None, and nothing runs twice.
    A task that runs again because an executor was lost may count its rows again where a shuffle
    follows, so the numbers are a report and not what a step decides by.
    """

    def __init__(self, df: DataFrame, columns: Sequence[Column], patience: float = 60.0):
        self._patience = patience
        self._seen = Observation()
        self.rows = df.observe(self._seen, *columns)

    def counts(self) -> dict[str, int] | None:
        got: dict[str, int] = {}
        waiter = threading.Thread(target=lambda: got.update(self._seen.get), daemon=True)
        waiter.start()
        waiter.join(self._patience)
        return {name: value or 0 for name, value in got.items()} if got else None
