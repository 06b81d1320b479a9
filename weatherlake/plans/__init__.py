"""Registered queries with their SQL oracles.

Importing this package fills ``catalog.REGISTRY``.
"""

from weatherlake.plans import catalog
from weatherlake.plans import climate, cluster, ingest, maps, stations, stores  # noqa: F401

REGISTRY = catalog.REGISTRY
