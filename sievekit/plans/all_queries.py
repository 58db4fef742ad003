"""Import every query module so the registry is complete."""

from . import catalog, catalog_branches, catalog_eval, catalog_model, catalog_sources  # noqa: F401
from .registry import REGISTRY

__all__ = ["REGISTRY"]
