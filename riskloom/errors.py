"""Typed errors raised by riskloom instead of generic runtime failures."""


class RiskloomError(RuntimeError):
    """Base class of every error raised by this package."""


class CatalogMismatch(RiskloomError):
    """A table does not carry the columns/types the feature catalog declares."""


class EmptyInput(RiskloomError):
    """An estimator was asked to fit on a table without rows."""


class SingleClassLabel(RiskloomError):
    """The label column holds only one class; a classifier cannot be trained."""


class ModelUnavailable(RiskloomError):
    """No persisted pipeline exists (or it cannot be loaded) at the given path."""


class ScratchUnavailable(RiskloomError):
    """No shared checkpoint folder is configured on a cluster session."""
