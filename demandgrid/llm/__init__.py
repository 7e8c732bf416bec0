"""Operators for training-data pipelines over documents, pages and benchmarks.

Functions that run in Python workers travel by value, so executors need numpy,
pyarrow and xxhash but no installed copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
