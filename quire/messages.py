"""Message texts of the publish and storage surface.

Fixed values: these formats are kept equal to the ones users of the original
publishing API see, so code that matches on error messages keeps working.
"""

NOT_A_FRAME = "df must be a DataFrame"
NO_WRITER = "df must have write attribute"
BAD_NAME = "dataset_name must be a non-empty string"
BAD_DESCRIPTION = "dataset_description must be a string"
BAD_TAGS = "tags must be a dictionary or None"
BAD_MODE = "Invalid mode: {mode}. Must be one of: overwrite, append, error, ignore"
BAD_TARGET = "target_path must be a non-empty string"
BAD_SOURCE = "source_path must be a non-empty string"
BAD_PATH = "path must be a non-empty string"
EMPTY_PATH = "path cannot be empty"
WRITE_FAILED = "Failed to write data to storage at {path}: {error}"
READ_FAILED = "Failed to read data from {path}: {error}"
DELETE_FAILED = "Failed to delete: {error}"
REGISTER_FAILED = "Failed to create data catalog entry. correlation-id: {correlation_id}"
