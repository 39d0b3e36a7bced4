"""bibgraph: bibliographic property-graph analytics on Spark DataFrames.

Subpackages: ``sources`` (readers, fixtures, payloads, CSV), ``functions``
(column expressions), ``operators`` (upserts, builders, cleaning, sampling,
keywords, profiling, graph algorithms), ``plans`` (analytics, recommender,
algorithm procedures, query registry), ``streaming`` (incremental loads).
"""

from .graph import Graph  # noqa: F401

__version__ = "0.1.0"
