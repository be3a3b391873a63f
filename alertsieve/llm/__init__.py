"""Operators of a training-data pipeline: one module per operator, ``queries``
registers them and ``oracle`` holds the SQL they are compared with."""

import sys

from pyspark import cloudpickle

# functions of this subpackage travel to the tasks by value, so that Python workers need not
# have the package on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])
