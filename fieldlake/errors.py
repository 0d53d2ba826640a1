"""Errors the library raises on purpose."""


class SourceError(RuntimeError):
    """An unknown source, environment or missing input."""


class ContractError(ValueError):
    """A table does not have the columns or types its contract names."""


class QualityError(RuntimeError):
    """A critical check failed; nothing downstream may run."""
