"""weftline: corpus analytics on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# functions travel to the executors with their plan, so that these need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
