"""Brindle: a PySpark-native analytics toolkit for tables, text and event streams.

Every operator is a plain function ``DataFrame(s) + column names -> DataFrame``.
Catalyst plans, AQE re-plans, Tungsten executes.
"""

from brindle.session import build_session

__all__ = ["build_session"]
