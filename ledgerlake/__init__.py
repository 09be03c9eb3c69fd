"""ledgerlake — Spark-native multi-platform retail settlement and daily P&L.

Packages: ``functions`` (parsing policies, predicates), ``operators`` (joins
and first-row / numbering operators), ``plans`` (models, settlement,
reconciliation, quality jobs), ``sources`` (exports, files, sinks, schema),
``streaming`` (day-partition recompute), ``queries`` (one registered query per
operator key; see ``catalog.QUERIES``).
"""

__version__ = "0.1.0"
