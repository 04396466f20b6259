"""Training-data operators on Spark: quality, dedup, decontamination, tokens, archives.

Self-contained: nothing else in the library imports this subpackage. Task-side
Python functions are shipped by value, so executors need numpy, pandas and
pyarrow but not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
