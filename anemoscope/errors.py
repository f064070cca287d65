"""The one error type that reaches the user."""


class ReportError(Exception):
    """A plain-English failure of one stage of a run."""

    def __init__(self, message: str, stage: str = "run"):
        super().__init__(message)
        self.stage = stage
        self.message = message
