"""Errors raised on the driver for whole-table problems; bad rows carry a reason column instead."""


class DataValidationError(ValueError):
    """A table lacks required columns, holds unusable values, or does not exist."""


class ModelNotFittedError(RuntimeError):
    """A model was asked to score before it was fitted or loaded."""
