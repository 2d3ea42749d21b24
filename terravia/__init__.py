"""Loading, enriching and checking geographic layers as Spark DataFrames."""

from terravia.errors import LayerError

__all__ = ["LayerError"]
