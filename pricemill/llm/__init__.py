"""Operators of a training-data pipeline: texts, embeddings, pages and archives."""

import sys

from pyspark import cloudpickle

# Functions that run in executors travel with their code, so the workers need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
