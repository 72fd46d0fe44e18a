"""tidewatch — weekly site-monitoring analytics expressed as Spark DataFrame operators.

Every public operator is a ``DataFrame -> DataFrame`` function (lazy, composable);
pipelines in :mod:`tidewatch.plans` compose them into one Catalyst plan per job.
"""

__version__ = "0.1.0"
