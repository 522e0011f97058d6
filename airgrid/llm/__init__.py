"""Operators for preparing text corpora for language-model training.

Nothing outside this folder (and corpus_pipeline.py, which belongs to it) imports it.
Functions that run inside Spark tasks travel by value, so executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
