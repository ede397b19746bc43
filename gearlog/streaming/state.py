"""Per-machine state on a stream: running means that expire, and alerts.

Each operator keeps a small state for each machine, and an event-time timeout that ends
it when nothing has been heard for a while. Spark keeps the state in RocksDB beside the
tasks and its changes in the checkpoint, so a batch touches its own machines only and a
restart goes on where the last run stopped. States go to Python and back in batches with
the readings: a call to the state store for each machine costs more than its readings.

Readings of a machine are taken in time order within a batch and in the order of the
batches; one that is older than the last one taken is left out (the watermark drops
the very late ones before). A batch holds one machine's new readings in memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..params import SENSORS
from .readings import WATERMARK

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
HOUR_MS = 3_600_000


@contextmanager
def rocksdb(spark: SparkSession):
    """Streams started inside keep their state in RocksDB."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


class _PerMachine:
    """Readings in order, one state, and one timeout at the end of its life."""

    fields = ""  # of the state
    needs: tuple[str, ...] = ()  # columns of a reading that ``step`` takes
    columns: list[str] = []  # of the result

    def __init__(self, quiet_ms: int, order: list[str]):
        self.quiet_ms, self.order = quiet_ms, order

    def __call__(self, key, frames: Iterator[pd.DataFrame], kept: GroupState) -> Iterator[pd.DataFrame]:
        if kept.hasTimedOut:
            out = self.over(key, kept.get)
            kept.remove()
            yield self.frame(out)
            return
        # microseconds, whatever unit the batch came in
        stamps, ranks, readings = [], [], []
        for f in frames:
            us = f["datetime"].to_numpy().astype("datetime64[us]").astype("int64").tolist()
            stamps += us
            by = (us if c == "datetime" else f[c].tolist() for c in self.order)
            ranks += zip(*([(v is None or v != v, v) for v in c] for c in by))  # missing ones last
            readings += zip(*(f[c].tolist() for c in self.needs))
        state = kept.getOption
        out: list[tuple] = []
        for i in sorted(range(len(stamps)), key=ranks.__getitem__):
            at = stamps[i]
            if state is not None and at < state[0]:
                continue
            if state is not None and at - state[0] > self.quiet_ms * 1000:
                out += self.over(key, state)
                state = None
            state, rows_out = self.step(key, at, readings[i], state)
            out += rows_out
        if state is not None:
            kept.update(tuple(state))
            kept.setTimeoutTimestamp(self.ends(state[0]))
        elif kept.exists:
            kept.remove()
        yield self.frame(out)

    def ends(self, at: int) -> int:
        return at // 1000 + self.quiet_ms

    def frame(self, rows: list[tuple]) -> pd.DataFrame:
        found = zip(*rows) if rows else ((),) * len(self.columns)
        out = {}
        for c, values in zip(self.columns, found):
            time = c in ("datetime", "at")
            out[c] = np.array(values, dtype="int64").astype("datetime64[us]") if time else list(values)
        return pd.DataFrame(out)

    def over(self, key, state) -> list[tuple]:
        """Rows that the end of a state gives."""
        return []

    def step(self, key, at: int, reading, state) -> tuple[list | None, list[tuple]]:
        raise NotImplementedError


class _Means(_PerMachine):
    needs = SENSORS
    fields = "readings long, " + ", ".join(f"{s} double" for s in SENSORS)
    columns = ["machineID", "datetime", "hours_since_last", "readings", *[f"{s}_ewma" for s in SENSORS]]

    def __init__(self, quiet_ms: int, order: list[str], alpha: float):
        super().__init__(quiet_ms, order)
        self.alpha = alpha

    def step(self, key, at, reading, state):
        waited = None if state is None else (at - state[0]) / 3.6e9
        n = 1 if state is None else state[1] + 1
        means = []
        for k in range(len(SENSORS)):
            x, old = reading[k], None if state is None else state[2 + k]
            if x is None or x != x:
                means.append(old)
            else:
                means.append(x if old is None else self.alpha * x + (1 - self.alpha) * old)
        return [at, n, *means], [(key[0], at, waited, n, *means)]


class _Alerts(_PerMachine):
    needs = ("zscore",)
    fields = "readings long, peak double"
    columns = ["machineID", "at", "event", "readings", "peak"]

    def __init__(self, quiet_ms: int, order: list[str], raise_at: float, clear_at: float):
        super().__init__(quiet_ms, order)
        self.raise_at, self.clear_at = raise_at, clear_at

    def step(self, key, at, reading, state):
        z = abs(reading[0]) if reading[0] is not None else float("nan")
        if state is None:
            if z > self.raise_at:
                return [at, 1, z], [(key[0], at, "raised", 1, z)]
            return None, []
        n, peak = state[1] + 1, max(state[2], z) if z == z else state[2]
        if z < self.clear_at:
            return None, [(key[0], at, "cleared", n, peak)]
        return [at, n, peak], []

    def over(self, key, state):
        return [(key[0], state[0] + self.quiet_ms * 1000, "timeout", state[1], state[2])]


def _per_machine(stream: DataFrame, processor: _PerMachine, schema: str, late: str) -> DataFrame:
    if "datetime" in stream.columns and late:
        stream = stream.withWatermark("datetime", late)
    return stream.groupBy("machineID").applyInPandasWithState(
        processor, schema, f"at long, {processor.fields}", "append", GroupStateTimeout.EventTimeTimeout
    )


def machine_state(
    readings: DataFrame, alpha: float = 0.1, expiry_hours: float = 48, order=("datetime",), late: str = WATERMARK
) -> DataFrame:
    """Every reading with its machine's state: hours since the last reading, readings
    and exponential means since the state began. After ``expiry_hours`` without a
    reading the state is dropped and the next reading begins a new one."""
    schema = "machineID long, datetime timestamp, hours_since_last double, readings long, "
    schema += ", ".join(f"{s}_ewma double" for s in SENSORS)
    means = _Means(int(expiry_hours * HOUR_MS), list(order), alpha)
    return _per_machine(readings, means, schema, late)


def alert_states(
    scored: DataFrame,
    raise_at: float = 3.0,
    clear_at: float = 2.0,
    quiet_hours: float = 48,
    order=("datetime",),
) -> DataFrame:
    """Alerts from readings with ``zscore`` (and a watermark), each raised once.

    A machine's alert is raised by a score beyond ``raise_at`` and held until one
    below ``clear_at`` clears it, whatever happens between the two; without any
    reading for ``quiet_hours`` it times out. One row for each event: when, what, and
    the alert's readings and highest score so far. Readings without a score hold.
    """
    alerts = _Alerts(int(quiet_hours * HOUR_MS), list(order), raise_at, clear_at)
    schema = "machineID long, at timestamp, event string, readings long, peak double"
    return _per_machine(scored, alerts, schema, "")
