"""shoplens: retail member analytics as Spark DataFrame operators.

Every operator is a function from DataFrames to a DataFrame built only from
built-in Spark expressions, so Catalyst can push filters into the scan, prune
columns, aggregate map-side and pick the join strategy.  Nothing is collected
to the driver; callers decide how to sink the result.
"""

from shoplens.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
