"""All named queries; importing this package registers them."""

from . import cleaning, files, reports, selection  # noqa: F401
from .registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
