"""Query registry shared by ``__spark_entry__``, ``bench.py`` and the tests."""

from __future__ import annotations

from collections.abc import Callable

REGISTRY: dict[str, tuple[Callable, str | None, str]] = {}


def query(name: str, sql: str | None = None, covers: str = ""):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``.

    ``covers`` lists the SURVEY ids the query exercises.
    """
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, sql, covers)
        return fn
    return deco


def load_all() -> dict:
    # importing the binding modules fills REGISTRY
    from tessera.plans import alerts, flights, io, misc, models, payments, recsys, stats, streams, text  # noqa: F401
    return REGISTRY
