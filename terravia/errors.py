"""Errors raised while a plan is being built."""


class LayerError(ValueError):
    """A layer, a column or a parameter does not fit the requested operation."""
