"""veracorp: a PySpark-native engine for labelled text-corpus analytics.

Every operator takes and returns DataFrames; the heavy lifting is done by
Catalyst-planned built-in expressions, windows, higher-order functions and
MLlib.  See README.md for the operator map.
"""

from veracorp.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
