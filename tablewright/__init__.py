"""Workforce, retail and data-cleaning analytics on Spark.

Functions of this package that run inside Python workers (``mapInPandas``,
stateful stream processors) are pickled by value, so executors need no copy
of the package on their path.
"""

import sys

from pyspark import cloudpickle as _cloudpickle

_cloudpickle.register_pickle_by_value(sys.modules[__name__])
