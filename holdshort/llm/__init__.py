"""Operators of a training-data pipeline over tables of texts, vectors and pages.

Functions that run in Python workers travel with the job, so the workers need numpy and the tokenizer libraries, but not
this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
