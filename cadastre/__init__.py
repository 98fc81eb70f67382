"""cadastre — Spark-native engine for periodic public-registry snapshots.

Sub-packages: ``sources`` (listing, archives, CSV), ``functions`` (column
expressions), ``operators`` (joins, state, queries, search), ``plans``
(tracked upsert, publish, monthly run, indexes, sinks) and ``streaming``.
"""

__version__ = "0.1.0"
