"""Readers and writers, and the boundaries to services that are not part of the engine."""
