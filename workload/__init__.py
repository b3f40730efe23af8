"""The checked queries, one module per part of the library."""

from workload.base import ORACLES, QUERIES
from workload import cluster, imagery, raster, vector  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
