"""Named queries over the given tables, each with its SQL twin where there is one."""

from __future__ import annotations

from collections.abc import Callable

from reviewloom.session import tune

FAMILIES = ["sources", "scalars", "relational", "quality", "labels", "sampling", "evaluation", "documents"]

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        def run(spark, sf_dir):
            from reviewloom.sources.adapters import Tables

            return fn(Tables(tune(spark), sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def load_all() -> None:
    from importlib import import_module

    for family in FAMILIES:
        import_module(f"reviewloom.catalog.{family}")
