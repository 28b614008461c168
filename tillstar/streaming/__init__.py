"""Incremental and streaming loads."""
