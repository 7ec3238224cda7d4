"""All registered queries; importing the package fills the registry."""

import importlib

from reviewloom.catalog.registry import ORACLE, QUERIES

for _area in (
    "sources",
    "cleaning",
    "features",
    "profiling",
    "vectors",
    "topic_models",
    "labeling",
    "sentiment",
    "evaluation",
    "insights",
    "recommendations",
    "reports",
):
    importlib.import_module(f"reviewloom.catalog.{_area}")

__all__ = ["ORACLE", "QUERIES"]
