"""Readers and writers. Paths, formats and options are parameters; the caller owns the session."""
