"""Operators that prepare training text; nothing else in the library imports this folder.

For all of them: an empty table gives an empty result; texts are processed whole, however
long; columns that an operator does not read are ignored, whatever their names, and kept by
the functions that return rows of their input. Nulls and repeated rows: see each module.

Functions of this folder travel to executors by value, so executors need only the public
libraries that they use.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
