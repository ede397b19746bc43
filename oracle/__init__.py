"""DuckDB statements that state independently what each registered query returns."""

from . import base


def all_sql() -> dict[str, str]:
    from . import (
        advanced,
        cost,
        evaluation,
        explore,
        failures,
        features,
        fleet,
        health,
        history,
        kpi,
        maintenance,
        quality,
        streams,
    )

    out: dict[str, str] = {}
    for module in (
        explore,
        health,
        failures,
        maintenance,
        cost,
        fleet,
        advanced,
        history,
        features,
        quality,
        evaluation,
        kpi,
        streams,
    ):
        for name, sql in module.SQL.items():
            out[name] = base.statement(sql)
    return out
