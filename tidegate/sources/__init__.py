"""Table, range and file sources."""
