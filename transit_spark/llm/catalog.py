"""The registered queries of this subpackage."""

from __future__ import annotations

from transit_spark.llm import divergence, infill, language, licenses, lines, near_vectors, neighbours, packing, pieces, quality, sharding, simhash, token_counts

MODULES = (pieces, licenses, quality, near_vectors, language, simhash, neighbours, lines, packing, sharding, infill, token_counts, divergence)
QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
