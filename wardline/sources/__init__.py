"""Readers, writers, saved state and the event views over the source tables."""
