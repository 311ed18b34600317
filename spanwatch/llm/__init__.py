"""Operators of a training-data pipeline over tables of texts.

Their Python functions travel with the tasks, so executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

from spanwatch.llm.catalog import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]

cloudpickle.register_pickle_by_value(sys.modules[__name__])
