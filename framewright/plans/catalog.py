"""Import every catalog module so its queries register."""

from . import catalog_clean, catalog_eval, catalog_features, catalog_models, catalog_profile  # noqa: F401
from .registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
