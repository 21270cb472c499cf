"""kerbside: driver-safety analytics written as Spark DataFrame and Structured Streaming jobs."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the job, so the package need not be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
