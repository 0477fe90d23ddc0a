"""Readers, sinks and the staging area."""
