"""The one exception type the library raises for bad input or settings."""


class DataError(ValueError):
    """Bad settings or unusable input; ``field`` names the setting at fault."""

    def __init__(self, message: str, field: str | None = None) -> None:
        super().__init__(message)
        self.field = field
