"""detlake: Spark jobs over object-detection datasets, predictions and pipeline runs."""

import sys

from pyspark import cloudpickle

# functions of this package travel to the Python workers by value, so executors need no copy of it
cloudpickle.register_pickle_by_value(sys.modules[__name__])
