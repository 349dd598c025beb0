"""Fixed error codes; a message never carries row content."""

from __future__ import annotations

TRANSIENT = ("INTERNAL_ERROR",)


class BatchError(Exception):
    """A batch was stopped; ``str(error)`` is one of the fixed codes."""

    @property
    def transient(self) -> bool:
        """Worth a retry: only failures that the data did not cause."""
        return str(self) in TRANSIENT


class InvalidRecord(ValueError):
    """A raw record with another number of fields; says where, never what."""

    def __init__(self, site: str, file: str, line: int):
        super().__init__(f"invalid record: site {site}, {file}, line {line}")
        self.site, self.file, self.line = site, file, line
