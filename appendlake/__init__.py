"""Incremental ingestion of append-growing, multi-line CSV exports on Spark."""

import sys

from pyspark import cloudpickle

from appendlake.config import LakeConfig

# Tasks carry this package's functions with them, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["LakeConfig"]
