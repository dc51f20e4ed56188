"""Operators for building training data; nothing else in the library imports this package.

Functions of this package that run in tasks travel with the task, so executors need the public
libraries (numpy, pyarrow, xxhash, tiktoken), not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
