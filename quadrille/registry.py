"""The queries of the library with their oracles; the modules of ``quadrille.plans`` fill them in."""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict = {}


def FLAGSHIP(spark, sf_dir):
    """Everything inferred to lie in region 0: customers and suppliers, through the nations under it."""
    return QUERIES["nodes_in_category"](spark, sf_dir)


from .plans import graph_queries, ingest_queries, rdf_queries, shacl_queries  # noqa: E402,F401  they fill QUERIES and ORACLES
