"""Exceptions raised on the driver."""


class DataQualityError(ValueError):
    """A table breaks a structural rule: columns, key or value range."""
