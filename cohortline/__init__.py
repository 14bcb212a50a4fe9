"""Record-table analytics on Spark: layered cleaning, profiling, checks, model
preparation and monitoring, each operator a ``DataFrame -> DataFrame`` function."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

__version__ = "0.1.0"

# The few functions that run in Python workers travel by value, so executors need
# numpy and pandas but no installed copy of this package.
register_pickle_by_value(sys.modules[__name__])
