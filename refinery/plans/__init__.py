"""Query catalogue on the analytic tables: each entry is a Spark plan plus an
independent DuckDB SQL twin used as the correctness oracle."""

from .registry import QUERIES, ORACLES, query  # noqa: F401


def load_all() -> None:
    from . import dq, relational, star, cdc, history, files, streams, skew, layouts  # noqa: F401
