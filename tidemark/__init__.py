"""Event analytics on Spark DataFrames: windows, joins, patterns, rates, tables, telemetry."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Step functions travel to the executors with the job, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
