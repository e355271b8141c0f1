"""Exception types raised or reported by the catalogue layer."""

from __future__ import annotations


class QuireError(Exception):
    """Base class. ``commit_id`` is the correlation id of the failed publish."""

    def __init__(self, message: str, commit_id: str | None = None):
        super().__init__(message)
        self.commit_id = commit_id


class PublishError(QuireError):
    """The data write of a commit failed; its folder was removed."""


class RegistrationError(QuireError):
    """Writing the catalogue entry failed; the data folder was removed."""


class DatasetExistsError(QuireError):
    """mode='error' and the dataset already has live data."""


class DatasetNotFoundError(QuireError):
    """No live dataset (or version) with the given id."""


class VersionExpiredError(DatasetNotFoundError):
    """The version was there, and its data was given up by ``expire_versions``."""


class SchemaMismatchError(QuireError):
    """The frame does not fit the dataset's or the registered schema."""
