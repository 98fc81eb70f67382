"""All registered queries and their DuckDB oracles."""

from . import columns, discovery, indexes, ingest, reads, rows, search, sinks, state, streams  # noqa: F401  (registration side effects)
from .base import ORACLES, QUERIES
