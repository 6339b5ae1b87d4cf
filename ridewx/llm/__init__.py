"""Operators of a training-data pipeline over a table of documents.

Nothing else in the library imports this subpackage. Functions that run in
Python workers are shipped by value, so executors need only the installed
third-party packages.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
