"""Registered queries with their SQL; importing the other modules adds their queries to the same tables."""

from . import features, fits, queries, records
from . import classes  # after features, whose SQL it uses  # isort: skip
from . import gates, mixtures, outputs  # isort: skip

__all__ = ["classes", "features", "fits", "gates", "mixtures", "outputs", "queries", "records"]
