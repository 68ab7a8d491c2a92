"""hazeline: threat-document analytics expressed as Spark DataFrame plans."""

import sys

from pyspark import cloudpickle

# Python functions of this package travel to executors by value, so that a
# worker needs no copy of the package on its own path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
