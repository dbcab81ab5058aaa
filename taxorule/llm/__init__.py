"""Operators of a training-data pipeline. Nothing outside this subpackage imports it.

Functions of this subpackage travel to the executors by value, so a cluster runs them without
the package being installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
