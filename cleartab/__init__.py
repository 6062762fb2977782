"""Spark-native preparation of public microdata: tolerant scans, codebook
decoding, list and date parsing, version de-duplication, incremental
publishing, and the jobs that compose them."""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle


LINEAGE = "_ARQUIVO_ORIGEM"
"""Column that carries the source file of each row in published tables."""

# The few functions that run in Python workers travel with their tasks, so the
# package need not be installed on the executors.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
