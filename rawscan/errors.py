"""What the loaders raise before a query runs."""


class RawScanError(ValueError):
    """An argument or an object that a loader can't work with."""
