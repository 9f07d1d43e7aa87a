"""Evidence-first records engine on Spark."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions travel to the executors by value, so that workers need the package on no path of their own.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
