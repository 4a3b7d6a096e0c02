"""Query registry: name -> (Spark plan, DuckDB SQL twin or None, covered operator IDs)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Entry:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: Callable[[], str] | None
    ops: tuple[str, ...]


REGISTRY: dict[str, Entry] = {}


def register(name: str, sql: Callable[[], str] | str | None = None, ops: str = ""):
    def deco(fn):
        s = (lambda: sql) if isinstance(sql, str) else sql
        REGISTRY[name] = Entry(name, fn, s, tuple(ops.split()))
        return fn
    return deco


def load_all() -> dict[str, Entry]:
    """Import every catalog module (registration happens at import)."""
    import importlib
    for mod in ("core", "text_ops", "sources_sinks", "history_ops", "streams", "batch_ops", "matching"):
        try:
            importlib.import_module(f"laborlens.catalog.{mod}")
        except ModuleNotFoundError as e:
            if e.name != f"laborlens.catalog.{mod}":
                raise
    return REGISTRY
