"""Place-intelligence analytics on Spark DataFrames.

Functions that run in Python workers are pickled by value, so that executors need nothing but PySpark and the third-party
libraries: the package itself does not have to be installed on them.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
