"""Named queries over the given tables, each with its SQL twin where one exists."""

from __future__ import annotations

from importlib import import_module

from .registry import ORACLES, QUERIES

# Topic modules; importing one fills the registry.
TOPICS = (
    "requests",
    "filtering",
    "grains",
    "postprocessing",
    "comparison",
    "pivots",
    "charts",
    "geography",
    "relational",
    "expressions",
    "storage",
    "monitoring",
    "streams",
    "graphs",
    "learning",
)


def load() -> None:
    for topic in TOPICS:
        import_module(f"{__name__}.{topic}")


__all__ = ["ORACLES", "QUERIES", "load"]
