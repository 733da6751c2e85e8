"""Energy-demand analytics and forecasting as Spark DataFrame jobs.

Layers: ``sources`` read and write files, ``functions`` are column
expressions, ``operators`` map DataFrames to DataFrames, ``plans`` chain
operators into the bronze, silver, gold, training and monitoring jobs, and
``catalog`` registers one runnable query per operator.
"""

import sys

from pyspark import cloudpickle

# Functions sent to executors travel whole, so a cluster needs no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
