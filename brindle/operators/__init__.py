"""Batch operators: ``DataFrame(s) + column names -> DataFrame``."""
