"""Error and status codes, and the exceptions raised by actions."""

from __future__ import annotations

# --- fixed values: codes that callers and audit readers match on ------------
ARRAY_EXPECTED = 51010
OBJECT_EXPECTED = 51011
BAD_REQUEST_FIELDS = 51012
DUPLICATE_REQUEST = 51013

INVALID_TIME_RANGE = 51000
ADVANCE_NEEDS_SUCCESS = 51003
ADVANCE_NEEDS_FIELDS = 51004
ADVANCE_NEEDS_CHANGE = 51005
WATERMARK_CONFLICT_NUMBER = 51006
OUTCOME_MISMATCH = 51007

AMBIGUOUS_RUN_SCOPE = "AMBIGUOUS_RUN_SCOPE"
NO_ACTIVE_CONFIGS = "NO_ACTIVE_CONFIGS"
INVALID_CONFIG_PAGE_SIZE = "INVALID_CONFIG_PAGE_SIZE"
UNSUPPORTED_DATABASE_ROUTE = "UNSUPPORTED_DATABASE_ROUTE"
UNSUPPORTED_FILE_ROUTE = "UNSUPPORTED_FILE_ROUTE"
UNSUPPORTED_FILE_FORMAT = "UNSUPPORTED_FILE_FORMAT"
UNSUPPORTED_FILE_WATERMARK = "UNSUPPORTED_FILE_WATERMARK"
STATE_NOT_FOUND = "STATE_NOT_FOUND"
INVALID_COPY_OPTIONS = "INVALID_COPY_OPTIONS"
LANDING_FILE_COUNT_MISMATCH = "LANDING_FILE_COUNT_MISMATCH"
WATERMARK_CONFLICT = "WATERMARK_CONFLICT"
FINALIZE_OUTCOME_MISMATCH = "FINALIZE_OUTCOME_MISMATCH"
BRONZE_CLEANUP_NOOP = "BRONZE_CLEANUP_NOOP"
BRONZE_CLEANUP_INCOMPLETE = "BRONZE_CLEANUP_INCOMPLETE"
BRONZE_CLEANUP_FAILED = "BRONZE_CLEANUP_FAILED"
LANDING_CLEANUP_INCOMPLETE = "LANDING_CLEANUP_INCOMPLETE"
LANDING_CLEANUP_FAILED = "LANDING_CLEANUP_FAILED"
FINALIZE_RESPONSE_FAILED_COMMITTED = "FINALIZE_RESPONSE_FAILED_COMMITTED"
FINALIZE_OUTCOME_UNCONFIRMED = "FINALIZE_OUTCOME_UNCONFIRMED"
FINALIZE_OUTCOME_LOOKUP_FAILED = "FINALIZE_OUTCOME_LOOKUP_FAILED"
# --- end of fixed values -----------------------------------------------------

# Codes of our own, where no published code exists.
INVALID_PROCESSING_BOUNDARY = "INVALID_PROCESSING_BOUNDARY"
HEADER_MISMATCH = "HEADER_MISMATCH"
SOURCE_QUERY_FAILED = "SOURCE_QUERY_FAILED"
INCOMPATIBLE_SCHEMA = "INCOMPATIBLE_SCHEMA"
LANDING_COPY_FAILED = "LANDING_COPY_FAILED"
LOAD_FAILED = "LOAD_FAILED"
INVALID_SOURCE_OPTIONS = "INVALID_SOURCE_OPTIONS"
MALFORMED_ROWS = "MALFORMED_ROWS"
CONNECTION_NOT_FOUND = "CONNECTION_NOT_FOUND"
BRONZE_CLEANUP_DONE = "BRONZE_CLEANUP_DONE"
AMBIGUOUS_SEED = "AMBIGUOUS_SEED"


class LoadError(Exception):
    """A named failure; ``code`` is the value written to the audit."""

    def __init__(self, code: str, message: str):
        super().__init__(f"{code}: {message}")
        self.code = code


class VersionTaken(LoadError):
    """Another writer claimed the next version of the control tables."""
