"""Connected components of an edge table: the core's, for edges whose columns have other names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import edge_components


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (smallest node that links reach), for every node of an edge."""
    return edge_components(edges.select(F.col(a).alias("a"), F.col(b).alias("b")))
