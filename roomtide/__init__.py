"""Occupancy analytics on Spark: sensor hubs to features, predictors and experiments."""

import sys

from pyspark import cloudpickle

# Functions run by tasks travel with the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
