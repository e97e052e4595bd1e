"""Registered queries: name -> (Spark job, DuckDB oracle text).

Each Spark job takes (spark, sf_dir) and returns a DataFrame over the whole
tables. The oracle text is independent SQL over the pre-registered tables.
Reported numbers use the same half-up rounding on both sides (ratios 6
decimals, money 2) so that summation order cannot change the value hash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake import config as C
from ledgerlake.session import round_half_up

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, Callable[[], str]] = {}


def register(name: str, oracle: Callable[[], str] | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


def money(c: str, name: str | None = None):
    return round_half_up(F.col(c), 2).alias(name or c)


def ratio(c: str, name: str | None = None, digits: int = 6):
    return round_half_up(F.col(c), digits).alias(name or c)


def load_all() -> None:
    """Import every module that registers queries."""
    from ledgerlake.plans import (  # noqa: F401
        q_audit,
        q_contract,
        q_models,
        q_monitor,
        q_policy,
        q_prep,
        q_profile,
    )
