"""Registry of the runnable queries and their oracle statements."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spinledger.functions.rounding import half_up
from spinledger.sources.driver_tables import Tables

BUILDERS: dict[str, Callable[[Tables], DataFrame]] = {}
ORACLES: dict[str, str] = {}

MODULES = ["gold", "features", "recommend", "feeds", "genres", "quality", "incremental"]


def query(name: str, oracle: str | None = None):
    """Register a builder that takes ``Tables``, with its oracle statement if it has one."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in BUILDERS:
            raise ValueError(f"query {name} is registered twice")
        BUILDERS[name] = build
        if oracle is not None:
            ORACLES[name] = oracle
        return build

    return register


def load() -> None:
    for module in MODULES:
        import_module(f"spinledger.plans.{module}_queries")


def runnable() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    load()
    return {
        name: (lambda spark, folder, build=build: build(Tables(spark, folder)))
        for name, build in BUILDERS.items()
    }


def oracles() -> dict[str, str]:
    load()
    return dict(ORACLES)


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Round computed doubles so that summation order does not show; all doubles by default."""
    names = columns or [name for name, kind in df.dtypes if kind == "double"]
    return df.withColumns({name: half_up(F.col(name), digits) for name in names})


def joined_text(df: DataFrame, *columns: str) -> DataFrame:
    """String arrays as bar-separated text."""
    return df.withColumns({name: F.array_join(name, "|") for name in columns})
