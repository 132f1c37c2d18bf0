"""Incremental harvests as streams."""
