"""Registry: name -> (Spark query, SQL twin)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .. import session
from .views import Inputs, with_views

_QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is the statement DuckDB answers identically."""

    def deco(fn):
        assert name not in _QUERIES, name
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLES[name] = with_views(sql)
        return fn

    return deco


def _bind(fn, prepared: str | None) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        session.tune(spark, sf_dir)
        return fn(Inputs(spark, sf_dir, prepared))

    return run


def queries(prepared: str | None = None) -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from . import load_all

    load_all()
    return {k: _bind(v, prepared) for k, v in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    from . import load_all

    load_all()
    return dict(_ORACLES)
