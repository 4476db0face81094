"""All registered queries and their DuckDB oracles."""

from . import base, classify, joining, layers, records, scalars, scans, streams, summary  # noqa: F401

QUERIES, ORACLES, COVERS = base.QUERIES, base.ORACLES, base.COVERS
