"""Operators for preparing training corpora, each a function from DataFrame to DataFrame.

Nothing else in the library imports this package.  Code that runs in Python workers is
sent by value, so executors need numpy and pyarrow but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
