"""Job-posting integration and analytics as Spark DataFrame operators."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

__version__ = "0.1.0"

# Ship the few Python functions by value, so that executors need no copy of this package.
register_pickle_by_value(sys.modules[__name__])
