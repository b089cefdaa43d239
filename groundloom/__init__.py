"""Land-cover mapping from satellite observations as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the task, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
