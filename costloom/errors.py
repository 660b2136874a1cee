"""Errors that integrity checks and the serving path raise."""


class DataQualityError(AssertionError):
    """An invariant of the data does not hold."""


class PersistenceError(RuntimeError):
    """A model bundle is missing, altered or would be overwritten."""


class LedgerError(RuntimeError):
    """The prediction ledger would become ambiguous."""


class ScoringAborted(RuntimeError):
    """Scoring stopped before it wrote predictions. soft: there was nothing new to score."""

    def __init__(self, message: str, soft: bool = False):
        super().__init__(message)
        self.soft = soft


class BacktestError(ValueError):
    """An origin or evaluation slice is not honest."""
