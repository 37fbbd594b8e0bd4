"""Incremental batch runs over folders that grow."""
