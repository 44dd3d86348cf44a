"""All registered queries."""

from __future__ import annotations

from importlib import import_module

from seqtide.catalog import registry

MODULES = ("curate", "encode", "homology", "neighbours", "density", "classify", "arrivals")


def _load() -> None:
    for name in MODULES:
        import_module(f"seqtide.catalog.{name}")


def queries() -> dict[str, registry.Query]:
    _load()
    return dict(registry.QUERIES)


def oracles() -> dict[str, str]:
    _load()
    return dict(registry.ORACLES)
