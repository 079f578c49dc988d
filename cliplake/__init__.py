"""Media-catalogue and text analytics as Spark DataFrame operators."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Functions used in Arrow UDFs travel with the job, so executors need no copy of this package.
register_pickle_by_value(sys.modules[__name__])
