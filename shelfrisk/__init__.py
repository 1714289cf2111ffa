"""shelfrisk: freshness and replenishment analytics on Spark DataFrames.

Every public operator is a function ``DataFrame -> DataFrame`` (or
``Column -> Column``) built from Spark SQL built-ins, so it composes with
``DataFrame.transform`` and runs unchanged in batch or streaming plans.
"""

from shelfrisk.session import configure, get_session, scratch_path

__all__ = ["configure", "get_session", "scratch_path"]
