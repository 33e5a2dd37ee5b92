"""PySpark-native lake and analytics operators for binary prediction-market fills."""

import sys

from pyspark import cloudpickle

from outcomelake.session import build_session, use_utc

# Functions that run inside tasks travel with the task, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["build_session", "use_utc"]
