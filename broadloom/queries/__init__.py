"""Named queries: each binds an operator to the test tables."""

from broadloom.queries.registry import oracles, registered

__all__ = ["oracles", "registered"]
