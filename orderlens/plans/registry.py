"""Import every query module so that its ``@register`` calls run."""

from . import queries  # noqa: F401
from .queries import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
