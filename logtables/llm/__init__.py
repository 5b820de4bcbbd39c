"""Operators for training-data pipelines over documents, pages, conversations and embeddings.

Nothing else in the library imports this package. Functions that run in Python workers are pickled by value, so
that executors need the public libraries only.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
