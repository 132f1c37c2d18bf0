"""Queries: operators bound to tables, each with equivalent SQL where SQL can express it."""
