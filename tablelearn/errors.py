"""Error classes raised by the operators."""


class TableLearnError(Exception):
    """Base class."""


class DataLoadError(TableLearnError):
    """A source could not be read or holds nothing usable."""


class ValidationError(TableLearnError):
    """A validation rule failed; ``violations`` lists (rule, column, count)."""

    def __init__(self, message, violations=None):
        super().__init__(message)
        self.violations = violations or []


class ModelError(TableLearnError):
    """Fitting or loading a model failed, or a precondition does not hold."""


class SizeBoundError(TableLearnError):
    """A side that must stay small (broadcast, driver literal) exceeded its bound."""
