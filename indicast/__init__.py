"""indicast — statistical indicator pipeline on Spark.

Every public function takes and returns ``pyspark.sql.DataFrame`` objects;
the heavy lifting (scans, joins, grouping, windows) is left to Catalyst.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Grouped-map and map-in-pandas functions of this package run in Python
# workers. Pickle them by value so the workers do not need the package on
# their import path (e.g. when the driver imports it from a checkout).
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

from indicast.session import build_session, checkpoint_dir  # noqa: E402

__all__ = ["build_session", "checkpoint_dir"]
