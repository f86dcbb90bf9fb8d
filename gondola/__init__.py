"""Retail price analytics as Spark DataFrame jobs.

``sources`` read archives, catalogues and lake tables; ``operators`` are
DataFrame-to-DataFrame functions; ``plans`` chain them into the raw -> Silver -> Gold
jobs; ``workload`` runs the operators over the shared test tables.
"""

from gondola.settings import Settings

__all__ = ["Settings"]
