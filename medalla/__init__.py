"""medalla: a retail Bronze -> Silver -> Gold pipeline on Spark DataFrames."""

import sys as _sys

__version__ = "0.1.0"

# The few functions that run inside Python workers (the Arrow passes) are
# shipped by value, so executors need not have this package on their path.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # older cloudpickle: fall back to by-reference pickling
    pass
