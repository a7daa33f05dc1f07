"""The registered queries, one module per operator family."""

from tagloom.catalogue import features, kept, metadata, models, relational, scalars, sources, tags  # noqa: F401
from tagloom.catalogue.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
