"""Two-sided event analytics as plain Spark DataFrame functions."""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel with the job: workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
