"""Operators of a training-data pipeline (documents, pages, embeddings, conversations).

Nothing outside this folder imports it. Its functions travel to the workers by value, so
executors need the installed libraries but not this package on their path."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
