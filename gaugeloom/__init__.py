"""Device telemetry time series as Spark jobs."""

import sys

from pyspark import cloudpickle

# The few Python functions that run in tasks travel with the job, so executors
# need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
