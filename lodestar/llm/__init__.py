"""Operators for large-scale training-data pipelines (see ``queries``).

Functions of this subpackage that run inside Python workers are shipped by value,
so executors need no copy of the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
