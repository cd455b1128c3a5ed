"""The two errors a caller is expected to handle."""


class SchemaError(ValueError):
    """The input file or frame does not have the structure the load needs."""


class FilterError(ValueError):
    """A report filter is malformed."""
