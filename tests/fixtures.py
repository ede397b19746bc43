"""Small hand-made fleet tables."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

from gearlog.sources.tables import SCHEMAS, Tables

T0 = datetime(2015, 1, 1)


def hours(n: float) -> datetime:
    return T0 + timedelta(hours=n)


def tables(spark, telemetry=(), errors=(), maint=(), failures=(), machines=()) -> Tables:
    given = {
        "telemetry": telemetry,
        "errors": errors,
        "maint": maint,
        "failures": failures,
        "machines": machines,
    }
    return Tables(**{n: spark.createDataFrame(list(r), SCHEMAS[n]) for n, r in given.items()})


def reading(at: float, machine: int = 1, volt: float = 170.0, vibration: float = 40.0):
    return (hours(at), machine, volt, 450.0, 100.0, vibration)


def noisy(machines: int, rows: int, seed: int = 7, step: float = 1.0):
    """Hourly readings; machine 1 has as many as all the others together."""
    rnd = random.Random(seed)
    out = []
    for m in range(1, machines + 1):
        n = rows * (machines - 1) if m == 1 else rows
        for i in range(n):
            out.append(
                (
                    hours(i * step),
                    m,
                    170 + rnd.gauss(0, 10),
                    450 + rnd.gauss(0, 50),
                    100 + rnd.gauss(0, 10),
                    40 + rnd.gauss(0, 5),
                )
            )
    return out


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())
