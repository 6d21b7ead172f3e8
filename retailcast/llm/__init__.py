"""Training-data operators: search, dedup, quality, secrets, mixing, packing, extraction.

Functions that run in Spark's Python workers are shipped by value, so executors
need only numpy, pyarrow and the few libraries an operator names, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
